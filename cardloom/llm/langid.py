"""Language identification with error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier on hashed
character n-grams is trained to tell the languages with a 1 from those with a 0.
A text gets the language whose codeword has the least loss against the bits'
margins, each bit weighted by how well it did in training; a text whose two
least losses are close is flagged as ambiguous.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import fold, text_slices

PER_LANGUAGE = 500  # most documents of a language to learn from
SENT = 100_000  # most languages whose counts are sent to every executor, instead of the texts to them
IN_ALL = 8000  # about as many documents to learn from in all; each holds FEATURES floats on the driver
FEATURES = 1 << 12
CLOSE = 0.1


def codewords(n: int, most_bits: int = 63):
    """n x bits matrix of -1 and 1: every way to part n languages in two, or for many languages random ones."""
    import numpy as np

    if n <= 7:
        # the first language has a 1 in each bit; no bit has a 1 for all
        rows = [(1, *b) for b in product((1, -1), repeat=n - 1)][1:] or [(1,) * n]
        return np.array(rows[: max(1, most_bits)]).T
    rng = np.random.default_rng(3)
    best = None
    for _ in range(50):
        code = rng.choice([-1, 1], (n, most_bits))
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


def counts(texts: list[str]):
    """Row-normalised counts of hashed 1- to 3-grams of letters; runs of other characters are one blank."""
    import numpy as np

    out = np.zeros((len(texts), FEATURES), np.float32)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= 500_000) and last - first < 256:
            size += len(texts[last]) + 1
            last += 1
        some = texts[first:last]
        c = np.frombuffer((" " + " ".join(some)).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        # ends found from the lower-cased lengths, which may differ from the texts'
        ends = np.cumsum([len(t.lower()) + 1 for t in some])
        if ends[-1] != len(c):
            for i, t in enumerate(some):
                out[first + i] = counts_of_one(t)
            first = last
            continue
        row = np.repeat(np.arange(len(some)), np.diff(np.concatenate([[0], ends])))
        add_counts(out[first:last], c, row)
        first = last
    out /= np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)
    return out


def counts_of_one(text: str):
    import numpy as np

    out = np.zeros((1, FEATURES), np.float32)
    c = np.frombuffer((" " + text.lower()).encode("utf-32-le", "surrogatepass"), np.uint32)
    add_counts(out, c, np.zeros(len(c), np.int64))
    return out[0]


def add_counts(out, c, row) -> None:
    """Adds the n-grams of code points c, each in its row, to out."""
    import numpy as np

    letter = ((c >= 97) & (c <= 122)) | (c >= 0xAA)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of others stays, as a blank
    c = np.where(letter, c, np.uint32(32))[keep]
    row = row[keep] * FEATURES
    mix = np.uint32(0x9E3779B1)
    gram = np.zeros(len(c), np.uint32)
    for n in range(1, 4):
        gram = gram[: len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1 :] if n > 1 else c.copy()
        if not len(gram):
            break
        where = ((gram * mix) ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(20)
        out += np.bincount(row[: len(gram)] + where, minlength=out.size).reshape(out.shape)


class Model:
    """Languages, their codewords, and for each bit a linear classifier and a weight."""

    def __init__(self, languages: list[str], code, linear, bit_weight):
        self.languages, self.code, self.linear, self.bit_weight = languages, code, linear, bit_weight

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, score, ambiguous) of each text; a text without a letter is ('und', 0, True)."""
        import numpy as np

        out = [("und", 0.0, True)] * len(texts)
        some = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
        if not some or not self.languages:
            return out
        loss = np.vstack([self.losses(counts([texts[i] for i in some[k : k + 1024]])) for k in range(0, len(some), 1024)])
        share = np.exp(-8 * (loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        order = np.argsort(loss, 1, kind="stable")
        for k, i in enumerate(some):
            best = order[k, 0]
            near = len(self.languages) > 1 and loss[k, order[k, 1]] - loss[k, best] < CLOSE
            out[i] = (self.languages[best], float(share[k, best]), bool(near))
        return out

    def losses(self, x):
        """Weighted mean logistic loss of each language's codeword."""
        import numpy as np

        margin = x @ self.linear[:-1] + self.linear[-1]
        return np.stack([np.logaddexp(0, -margin * c) @ self.bit_weight for c in self.code], 1) / self.bit_weight.sum()


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL) -> Model:
    """Learns from a bounded sample of the documents given; null languages and texts are left out.

    Every language has its share of the sample: per_language documents, or fewer
    where there are so many languages that in_all would be passed.
    """
    import numpy as np

    known = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts_ = known.groupBy("lang").count()
    n = counts_.count()
    share = max(1, min(per_language, in_all // max(n, 1)))
    # a hash of id and text picks the rows
    u = F.xxhash64("doc_id", "text", F.lit("sample")).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    rows = known.join(F.broadcast(counts_) if n <= SENT else counts_, "lang").where(u < 1.2 * share / F.col("count")).drop("count").limit(2 * max(in_all, n)).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model([], None, None, None)
    x = counts([r["text"] for r in rows])
    y = np.array([languages.index(r["lang"]) for r in rows])
    code = codewords(len(languages))
    target = code[y]  # rows x bits
    share = np.bincount(y, minlength=len(languages))
    w = (1 / share)[y][:, None]
    w = w / w.mean()
    linear = np.zeros((FEATURES + 1, code.shape[1]), np.float32)
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    speed = np.zeros_like(linear)
    for _ in range(150):
        p = 1 / (1 + np.exp(np.clip((x1 @ linear) * target, -30, 30)))
        g = -(x1.T @ (w * p * target)) / len(x) + 1e-6 * linear
        speed = 0.9 * speed - 2.0 * g
        linear += speed.astype(np.float32)
    error = (w * ((x1 @ linear) * target <= 0)).mean(0)
    bit_weight = np.log((1 - error + 0.01) / (error + 0.01)).clip(0.05)
    return Model(languages, code, linear, bit_weight)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Rows doc_id, lang_pred, score, ambiguous for every whole text.

    A null text, and one without any letter, is `und` with score 0. Repeated
    rows get equal rows, other columns are ignored, an empty table gives an
    empty table.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            own = batch.column("doc_id")
            for first, texts in text_slices(batch):
                lang, score, near = zip(*model.predict(texts), strict=True)
                yield pa.RecordBatch.from_arrays([own.slice(first, len(texts)), pa.array(lang), pa.array(score, pa.float64()), pa.array(near)], ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def identify_documents(docs: DataFrame) -> DataFrame:
    """Learns where crc32(doc_id) mod 3 is not 1 and identifies all documents."""
    model = fit(docs.where(fold("doc_id", 3) != 1))
    return identify(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")
