"""Quality by compression with trained dictionaries.

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is cut into pieces and each piece is compressed with either
dictionary and with none. The difference of the two sizes, normalised by the
size without a dictionary, says which of the two kinds a piece looks like; a
logistic regression on the pieces' mean, least and greatest difference and on
how well the text compresses at all turns it into a calibrated score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import fit_logistic, fold, labelled_texts, text_slices

DICTIONARY_BYTES = 64 * 1024
GOOD, BAD = 2000, 2000  # most labelled documents to learn from
PIECE = 2048  # bytes; short enough for a dictionary to matter
LEVEL = 1


def pieces(text: str, size: int = PIECE) -> list[bytes]:
    """The whole text as UTF-8 in pieces of `size` bytes; the empty text is one empty piece."""
    data = text.encode("utf-8", "surrogatepass")
    return [data[i : i + size] for i in range(0, len(data), size)] or [b""]


class Model:
    """Two dictionaries and the weights of the calibration."""

    def __init__(self, good: bytes, bad: bytes, weights=None):
        self.good, self.bad, self.weights = good, bad, weights
        self._made = None

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def compressors(self):
        if self._made is None:
            import zstandard as z

            made = []
            for d in (self.good, self.bad, b""):
                if d:
                    data = z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT if d[:4] != b"\x37\xa4\x30\xec" else z.DICT_TYPE_FULLDICT)
                    data.precompute_compress(level=LEVEL)
                    made.append(z.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False))
                else:
                    made.append(z.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False))
            self._made = made
        return self._made

    def features(self, text: str) -> list[float]:
        """Mean, least and greatest difference of the pieces; compressed share with a dictionary and without; length."""
        import math

        good, bad, none = self.compressors()
        total = sum_g = sum_b = sum_n = 0
        low, high = 1.0, -1.0
        for p in pieces(text):
            g, b, n = len(good.compress(p)), len(bad.compress(p)), len(none.compress(p))
            total, sum_g, sum_b, sum_n = total + len(p), sum_g + g, sum_b + b, sum_n + n
            d = (b - g) / n
            low, high = min(low, d), max(high, d)
        size = max(total, 1)
        mean = (sum_b - sum_g) / sum_n
        share = sum_n / (size + 16)
        return [mean, low, high, share, share * share, min(sum_g, sum_b) / (size + 16), math.log1p(total), mean * math.log1p(total)]

    def score(self, text: str) -> float:
        import math

        z = sum(a * b for a, b in zip(self.weights, self.features(text), strict=False)) + self.weights[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of pieces of the texts; for too few of them, the pieces themselves."""
    import zstandard as z

    cut = [p for t in texts for p in pieces(t, 1024)]
    try:
        return z.train_dictionary(size, cut, level=LEVEL).as_bytes()
    except z.ZstdError:
        return b"".join(cut)[-size:]


def fit(docs: DataFrame, labels: DataFrame, good: int = GOOD, bad: int = BAD) -> Model | None:
    """Learns from a bounded sample of the labelled documents given; None without labels of both kinds.

    Half of the sample makes the dictionaries and the other half the
    calibration, which counts each class by its share among all labelled rows.
    """
    import numpy as np

    counts = {r[0]: r[1] for r in labels.groupBy("quality").count().collect()}
    rows = labelled_texts(docs, labels, "quality", {1: good, 0: bad})
    texts = {k: [r["text"] for r in rows if r["quality"] == k] for k in (0, 1)}
    if min(len(texts[0]), len(texts[1])) < 2:
        return None
    model = Model(dictionary(texts[1][::2]), dictionary(texts[0][::2]))
    x = np.array([model.features(t) for k in (0, 1) for t in texts[k][1::2]])
    y = np.array([k for k in (0, 1) for _ in texts[k][1::2]])
    w = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    mean, scale = x.mean(0), x.std(0) + 1e-9
    b = fit_logistic((x - mean) / scale, y, w, l2=1e-3)
    model.weights = [*(b[:-1] / scale).tolist(), float(b[-1] - (b[:-1] * mean / scale).sum())]
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows doc_id, score for every whole text; a null text is scored as the empty one.

    Without a model every score is 0.5. Repeated rows get equal rows, other
    columns are ignored, an empty table gives an empty table.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            own = batch.column("doc_id")
            for first, texts in text_slices(batch):
                s = [model.score(t) if model else 0.5 for t in texts]
                yield pa.RecordBatch.from_arrays([own.slice(first, len(texts)), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns where crc32(doc_id) mod 5 is not 0 and scores all documents."""
    model = fit(docs, labels.where(fold("doc_id", 5) != 0))
    return score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
