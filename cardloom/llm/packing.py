"""Best-fit packing by the sum-of-squares rule.

A document becomes its token ids and one end id; only a document longer than a
sequence is cut. A piece goes to the open sequence, or a new one, for which the
sum over gaps of (number of open sequences with that gap) squared is smallest.

The rule looks at the lengths alone, so only (doc_id, piece, length, checksum)
rows are shuffled. Pieces are dealt by hash into shards of bounded size; each
shard is packed on its own, the sequences that it leaves with a gap are opened
again, and what they hold is packed once more over far fewer shards.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import cut_lineage, text_slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_tokenizers: dict = {}


def byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: itself if printable in Latin-1, else the next one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def tokenizer_path(tokenizer: str) -> str:
    """A path as it is; the path, on this machine, of a public tokenizer's file name."""
    if "/" in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


def tokenizer_ids(path: str, cached: int = 500_000):
    """Function: texts -> list of little-endian uint32 bytes.

    This tokenizer drops white space and never joins across it, so the ids of a
    text are those of its white-space separated parts; these are remembered, at
    most `cached` of them beyond a batch. A part of plain letters and then
    punctuation is the ids of both, each straight from the tokenizer's model;
    other parts go through the whole tokenizer.
    """
    import re

    from tokenizers import Tokenizer

    if path in _tokenizers:
        return _tokenizers[path]
    tokenizer = Tokenizer.from_file(path)
    model = tokenizer.model
    letters = byte_letters()
    odd = re.compile("[\x1c-\x1f]")
    # below U+0250 but for U+0130 lower-casing and NFC change nothing else
    tame = re.compile("[\x00-\u012f\u0131-\u024f]*")
    plain = re.compile("([a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u01ba\u0250]+)([!\"#$%&()*+,\\-./:;=>?@\\[\\\\\\]^_`{|}~]*)")
    parts: dict[str, bytes] = {}
    pieces: dict[str, bytes] = {"": b""}

    def piece(p: str) -> bytes:
        if p not in pieces:
            shown = p if p.isascii() else "".join(letters[b] for b in p.encode())
            pieces[p] = b"".join(t.id.to_bytes(4, "little") for t in model.tokenize(shown))
        return pieces[p]

    def ids(texts: list[str]) -> list[bytes]:
        for d in (parts, pieces):
            if len(d) > cached:
                d.clear()
                pieces[""] = b""
        cut = []
        for t in texts:
            low = t.lower() if t.isascii() or tame.fullmatch(t) else t
            cut.append(re.split("[ \t-\r]+", low) if odd.search(t) else low.split())
        whole = []
        for p in {p for own in cut for p in own if p not in parts}:
            if (m := plain.fullmatch(p)) and (p.isascii() or p == p.lower()):
                parts[p] = piece(m[1]) + piece(m[2])
            else:
                whole.append(p)
        for p, e in zip(whole, tokenizer.encode_batch(whole, add_special_tokens=False), strict=True):
            parts[p] = b"".join(i.to_bytes(4, "little") for i in e.ids)
        return [b"".join(map(parts.__getitem__, own)) for own in cut]

    return _tokenizers.setdefault(path, ids)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32 for each piece of each document.

    A null text is empty and gives one piece of length 1; repeated rows and null
    ids give pieces of their own; other columns are ignored.
    """
    end = end_id.to_bytes(4, "little")

    def pieces(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = tokenizer_ids(tokenizer_path(tokenizer))
        for batch in batches:
            own = batch.column("doc_id").to_pylist()
            for first, texts in text_slices(batch):
                rows: list[tuple] = []
                for k, ids in enumerate(encode(texts), first):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((own[k], n, at // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces, PIECES)


def sum_of_squares(lengths, capacity: int):
    """Bin number and offset for each length, and each bin's gap; longest first.

    n[g] counts the open bins with gap g. Putting a piece of length l into a bin
    with gap g changes the sum of squares by 2 (n[g-l] - n[g]) + 2, or by
    1 - 2 n[g] if it fills the bin; a new bin adds 2 n[capacity-l] + 1. Equal
    changes go to the smallest gap.
    """
    import numpy as np

    n = np.zeros(capacity + 1, np.int64)
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []
    at = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    far = np.iinfo(np.int64).max
    for i in np.argsort(-np.asarray(lengths), kind="stable"):
        size = int(lengths[i])
        left = n[size:capacity]
        change = np.where(left > 0, 2 * (n[: capacity - size] - left) + 2, far)
        if size < capacity and left[0] > 0:
            change[0] = 1 - 2 * left[0]
        k = int(change.argmin()) if len(change) else -1
        if k >= 0 and change[k] != far and change[k] <= 2 * n[capacity - size] + 1:
            gap = size + k
            b = bins[gap].pop()
            n[gap] -= 1
        else:
            gap, b = capacity, len(gaps)
            gaps.append(capacity)
        at[i], offset[i] = b, capacity - gap
        gaps[b] = gap = gap - size
        if gap:
            bins[gap].append(b)
            n[gap] += 1
    return at, offset, np.asarray(gaps, np.int64)


def _pack(pieces: DataFrame, shards: int, capacity: int, level: int) -> DataFrame:
    def shard(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # the same pieces give the same packing, however they arrive
        table = table.take(pc.sort_indices(table, sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]))
        at, offset, gaps = sum_of_squares(table.column("length").to_numpy(), capacity)
        s = table.column("shard").to_numpy().astype(np.int64)
        out = table.drop_columns(["shard"])
        return out.append_column("sequence_id", pa.array((s * (1 << 32) + at) * 4 + level)).append_column("offset", pa.array(offset)).append_column("gap", pa.array(gaps[at] if len(at) else at))

    keyed = pieces.select(*[x.split()[0] for x in PIECES.split(", ")]).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(shards)).cast("int"))
    return keyed.groupBy("shard").applyInArrow(shard, PIECES + ", sequence_id long, offset long, gap long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, shard_pieces: int = 20_000) -> DataFrame:
    """Packs all documents; rows doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    tokenizer: a path, or the file name of a public tokenizer. shard_pieces bounds
    what one task packs. A null text is empty, a very long one is cut into pieces,
    repeated rows and null ids are packed like any other. An empty table gives no rows; ties
    are broken by doc_id, piece and checksum, so a lost task gives the same
    packing again. Pieces that fill a sequence need no partner and stay out of
    the shards.
    """
    pieces = cut_lineage(token_pieces(docs, tokenizer, capacity, end_id))
    full = F.col("length") >= capacity
    count = pieces.where(~full).count()
    whole = pieces.where(full).withColumn("sequence_id", F.monotonically_increasing_id() * 4).withColumn("offset", F.lit(0).cast("long"))
    first = cut_lineage(_pack(pieces.where(~full), max(1, -(-count // shard_pieces)), capacity, 1))
    left = first.where("gap > 0").count()
    again = _pack(first.where("gap > 0"), max(1, -(-left // shard_pieces)), capacity, 2)
    return whole.unionByName(first.where("gap = 0").drop("gap")).unionByName(again.drop("gap"))
