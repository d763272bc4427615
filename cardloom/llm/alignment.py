"""Alignment of two tokenizers' tokens over each distinct text.

Equal texts are tokenised and aligned once: the table is shuffled by full text and
counted, every distinct text gives its groups and its pairs of linked tokens, the
pairs are counted over the corpus with the texts' multiplicities as weights, and the
measures go back to the documents by a digest of the text.

Texts are cut before white space that follows another character, where both
tokenizers end a token; the alignment of a text is that of its chunks, of which a
worker remembers many. Texts with other white space, or characters that a vocabulary joins
across white space, are aligned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.bytebpe import chunks, encoder, is_tame, merge_ranks
from cardloom.llm.common import cut_lineage, text_slices, written
from cardloom.llm.packing import byte_letters, tokenizer_path

ALIGNED = "key string, docs long, valid boolean, n_a long, n_b long, n_groups long, groups string, pairs array<long>, links array<int>"
_aligners: dict = {}


class Aligner:
    """Tokenises with both vocabularies and aligns; one for each worker."""

    def __init__(self, path_a: str, path_b: str, cached: int = 500_000):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.ids_a = encoder(path_a, special=False)
        #: whether every text is its A tokens' bytes by the way the tokenizer is made
        self.exact_a = merge_ranks(path_a) is not None
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {c: bytes([b]) for b, c in byte_letters().items()}
        special = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = {i: special[i] if i in special else b"".join(map(byte_of.__getitem__, t)) for t, i in self.a.get_vocab().items()}
        self.n_ids_b = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_ids_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = {i: len(x) for i, x in self.bytes_a.items()}, [len(x) for x in self.bytes_b]
        joined = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and re.search("[^▁]▁|[ \t-\r]", p)]
        #: characters of pieces that reach over a place where texts are cut
        self.spoils = {c for p in joined for c in re.findall("[ \t-\r]", p)}
        self.cuts = not any(re.search("[^▁]▁", p) for p in joined) and not self.spoils & {" ", "\n", "\t"}
        self.known: dict[str, int] = {}
        self.cached = cached
        self._clear()

    def _clear(self) -> None:
        import numpy as np

        self.known.clear()
        self.n_a, self.n_b, self.n_groups, self.text, self.ok = [], [], [], [], []
        self.flat, self.ends = [np.empty(0, np.int64)], [0]

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a blank, which the tokenizer adds itself, or with other white space."""
        blank = [t[:1] == " " for t in texts]
        out = self.b.encode([t[1:] if b else t for t, b in zip(texts, blank, strict=True)], num_threads=1)
        # before other white space, the added blank is a token of its own; to nothing, none is added
        return [([self.b.piece_to_id("▁")] if t == " " else o) if b else o[1:] for t, o, b in zip(texts, out, blank, strict=True)]

    def align(self, text: str, a: list[int], b: list[int]):
        """(groups as text, number of groups, pair codes) or None where the tokens' bytes are not the text's."""
        raw = text.encode()
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw or not (self.exact_a or b"".join(map(self.bytes_a.__getitem__, a)) == raw):
            return None
        size_a, size_b, n_b = self.size_a, self.size_b, self.n_ids_b
        groups, codes = [], []
        i = j = i0 = j0 = 0
        # bytes by which the current A token ends after the current B token
        ahead = size_a[a[0]] - size_b[b[0]] if a else 0
        last = len(a)
        while True:
            codes.append(a[i] * n_b + b[j])
            if ahead == 0:
                i, j = i + 1, j + 1
                groups.append(f"{str(a[i0:i])[1:-1]}|{str(b[j0:j])[1:-1]}")
                if i == last:
                    break
                i0, j0 = i, j
                ahead = size_a[a[i]] - size_b[b[j]]
            elif ahead < 0:
                i += 1
                ahead += size_a[a[i]]
            else:
                j += 1
                ahead -= size_b[b[j]]
        return ";".join(groups).replace(" ", ""), len(groups), codes

    def _learn(self, new: list[str]) -> None:
        import numpy as np

        ids_a = self.ids_a(new)
        codes = []
        for c, a, b in zip(new, ids_a, self._ids_b(new), strict=True):
            got = self.align(c, a, b)
            self.known[c] = len(self.ok)
            self.ok.append(got is not None)
            groups, n, own = got or ("", 0, [])
            self.n_a.append(len(a))
            self.n_b.append(len(b))
            self.n_groups.append(n)
            self.text.append(groups)
            codes += own
            self.ends.append(self.ends[-1] + len(own))
        self.flat.append(np.asarray(codes, np.int64))

    def texts(self, texts: list[str]):
        """(n_a, n_b, n_groups, groups, pair codes, links) for each text; None where it has no tokens."""
        import numpy as np

        if len(self.known) > self.cached:
            self._clear()
        full = [" " + t for t in texts]
        # no piece crosses a cut, and every character is as both tokenizers see it
        tame = [bool(t) and self.cuts and is_tame(t) and "▁" not in t and not any(c in t for c in self.spoils) for t in texts]
        cut = [chunks(t) if ok else None for t, ok in zip(full, tame, strict=True)]
        new = list({c for own in cut if own for c in own if c not in self.known})
        if new:
            self._learn(new)
            self.flat = [np.concatenate(self.flat)]
        ends, flat, known = np.asarray(self.ends), self.flat[0], self.known
        counts = [np.asarray(x, np.int64) for x in (self.n_a, self.n_b, self.n_groups)]
        ok = np.asarray(self.ok, bool)
        for t, own in zip(full, cut, strict=True):
            if t == " ":
                yield None
            elif own is None:
                a, b = self.ids_a([t])[0], self.b.encode(t[1:])
                got = self.align(t, a, b)
                yield got and (len(a), len(b), got[1], got[0], *np.unique(np.asarray(got[2], np.int64), return_counts=True))
            else:
                k = np.fromiter(map(known.__getitem__, own), np.int64, len(own))
                if not ok[k].all():
                    yield None
                    continue
                size = ends[k + 1] - ends[k]
                at = np.repeat(ends[k] - np.cumsum(size) + size, size) + np.arange(size.sum())
                pairs = np.unique(flat[at], return_counts=True)
                yield (*[int(c[k].sum()) for c in counts], ";".join(map(self.text.__getitem__, k)), *pairs)


def aligned_texts(texts: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """Rows of ALIGNED for rows text, key, docs.

    pairs: codes of the distinct linked id pairs, the A id times B's vocabulary size plus the B id; links: how often each occurs.
    """

    def align(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        names = (tokenizer_path(tokenizer_a), tokenizer_path(tokenizer_b))
        if names not in _aligners:
            _aligners[names] = Aligner(*names)
        own = _aligners[names]
        schema = pa.schema([("key", pa.string()), ("docs", pa.int64()), ("valid", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int32()))])
        for batch in batches:
            keys, docs = batch.column("key").to_pylist(), batch.column("docs").to_pylist()
            for first, part in text_slices(batch, chars=1_000_000):
                rows = []
                for k, got in enumerate(own.texts(part), first):
                    n_a, n_b, n_groups, groups, pairs, links = got or (0, 0, 0, "", [], [])
                    rows.append((keys[k], docs[k], got is not None, n_a, n_b, n_groups, groups, pairs, links))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return texts.select("text", "key", "docs").mapInArrow(align, ALIGNED)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """Rows pair, docs, best: how many documents hold a pair linked, and whether that is its A id's highest count."""
    counts = aligned.select("docs", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("docs").alias("docs"))
    # of each A id's pairs only the count goes on
    highest = counts.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("docs").alias("highest"))
    joined = counts.withColumn("a", F.expr(f"pair div {size_b}")).join(highest, "a")
    return joined.select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, broadcast_pairs: int = 2_000_000) -> DataFrame:
    """Rows doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one for each row of docs.

    tokenizer_a: a byte-level tokenizer's file, tokenizer_b: a sentencepiece model;
    paths or names of public tokenizers. Null and empty texts, and those that either
    tokenizer does not give back byte by byte, have no tokens: zeros and ''.
    Repeated rows and ids are documents of their own and each counts; ties for
    an A id's highest count are all best. Very long texts are aligned whole, a null doc_id
    stays null, an empty table gives no rows, and other columns are ignored.

    The corpus counts are broadcast up to broadcast_pairs rows (16 bytes each), and
    joined by a shuffle beyond that.
    """
    from sentencepiece import SentencePieceProcessor

    size_b = SentencePieceProcessor(model_file=tokenizer_path(tokenizer_b)).vocab_size()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    has_text = F.length("text") > 0
    distinct = rows.where(has_text).groupBy("text").agg(F.count("*").alias("docs")).withColumn("key", F.sha2("text", 256))
    digests = aligned_texts(distinct, tokenizer_a, tokenizer_b).where("valid").withColumn("groups_sha256", F.sha2("groups", 256)).drop("groups", "valid")
    aligned = written(digests, "aligned-texts")
    counts = cut_lineage(pair_counts(aligned, size_b))
    own = ["key", "n_a", "n_b", "n_groups", "groups_sha256"]
    linked = aligned.select(*own, F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair")
    found = linked.join(F.broadcast(counts) if counts.count() <= broadcast_pairs else counts, "pair")
    # every text with tokens has a pair, and its own columns are the same in all of them
    sums = found.groupBy(*own).agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("docs")).alias("count_sum"))
    # rows without a text get keys of their own, so that they don't meet in one task
    key = F.when(has_text, F.sha2("text", 256)).otherwise(F.concat(F.lit("-"), F.xxhash64("doc_id").cast("string")))
    out = rows.select("doc_id", key.alias("key")).join(sums, "key", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "doc_id", *[number(F.col(c)).alias(c) for c in ("n_a", "n_b", "n_groups")], number(F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
        *[number(F.col(c)).alias(c) for c in ("n_best", "count_sum")], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
