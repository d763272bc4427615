"""Packing with a controlled mixture: deficit round-robin over one queue a source.

A document becomes its token ids and one end id, and joins the queue of its
source, in the order of the token table. In each round, one for each window of
`capacity` tokens, a source earns its share of the window. It sends packets of
`grain` tokens while what it has earned covers them, and carries the rest, its
deficit, to the next round; a queue that has run dry earns no more and the others go on. The
packets of all rounds form one stream, which is cut into sequences of `capacity`
tokens without gaps. So every stretch of the stream holds each source's share to
within a packet and a window, and a document is cut only between packets of different
rounds and at the ends of sequences.

What a source has sent by a round depends on its earnings alone: the whole packets
they cover. A packet's round and its place in the stream are therefore arithmetic on
its place in the queue, and deficits pass from partition to partition without a
common task: each partition needs only how many tokens of each source lie before it.
Ids are written once, and neither shuffled nor gathered.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardloom.llm.bytebpe import encoder
from cardloom.llm.common import text_slices, written
from cardloom.llm.packing import tokenizer_path

TOKENS = "part int, doc_id long, queue string, before long, n long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Rounds:
    """Where a source's tokens lie in the stream.

    totals: tokens of each source; weights: its share of a window, as integers of
    any common scale. All arithmetic is in exact integers.
    """

    def __init__(self, totals: list[int], weights: list[int], capacity: int, grain: int):
        self.totals, self.weights, self.capacity, self.grain = totals, weights, capacity, grain
        self.scale, self.all = sum(weights), sum(totals)
        self.full = self.all - self.all % capacity
        self.at = lru_cache(maxsize=65_536)(self._at)
        self.sends = lru_cache(maxsize=4096)(self._sends)

    def sent(self, source: int, round_: int) -> int:
        """Tokens that a source has sent by the end of a round: whole packets, or all it has."""
        earned = round_ * self.capacity * self.weights[source] // self.scale
        return self.totals[source] if earned >= self.totals[source] else earned - earned % self.grain

    def sent_by(self, round_: int) -> list[int]:
        """sent() of all sources."""
        grain, scale, budget = self.grain, self.scale, round_ * self.capacity
        return [t if (e := budget * w // scale) >= t else e - e % grain for t, w in zip(self.totals, self.weights, strict=True)]

    def _at(self, round_: int) -> list[int]:
        """The stream place at which each source's packets of a round begin; sources send one after the other."""
        before, after = self.sent_by(round_ - 1), self.sent_by(round_)
        place, out = sum(before), []
        for b, a in zip(before, after, strict=True):
            out.append(place)
            place += a - b
        return out

    def _sends(self, source: int, round_: int) -> tuple[int, int, int]:
        """What a source has sent before and by the end of a round, and the stream place of its packets there."""
        return self.sent(source, round_ - 1), self.sent(source, round_), self.at(round_)[source]

    def runs(self, source: int, first: int, last: int):
        """(queue place, length, stream place) of the tokens first..last of a queue, where the stream breaks them."""
        held = None
        while first < last:
            end = min(first - first % self.grain + self.grain, self.totals[source])
            begun, sent, place = self.sends(source, -(-end * self.scale // (self.capacity * self.weights[source])))
            size = min(last, sent) - first
            place += first - begun
            if held and held[2] + held[1] == place:
                held = (held[0], held[1] + size, held[2])
            else:
                if held:
                    yield held
                held = (first, size, place)
            first += size
        if held:
            yield held

    def sequence(self, place: int) -> tuple[int, int, int]:
        """(sequence, offset in it, tokens to its end) of a stream place.

        What is left beyond the last whole sequence is cut into powers of two, which need no padding.
        """
        if place < self.full:
            return place // self.capacity, place % self.capacity, self.capacity - place % self.capacity
        number, begin, rest = self.full // self.capacity, self.full, self.all - self.full
        while True:
            size = 1 << (rest.bit_length() - 1)
            if place < begin + size:
                return number, place - begin, begin + size - place
            number, begin, rest = number + 1, begin + size, rest - size

    def pieces(self, source: int, first: int, n: int):
        """(start in the document, length, sequence, offset) for a document of n tokens that begins at a queue place."""
        for at, size, place in self.runs(source, first, first + n):
            while size:
                number, offset, left = self.sequence(place)
                take = min(left, size)
                yield at - first, take, number, offset
                at, size, place = at + take, size - take, place + take


def token_table(docs: DataFrame, tokenizer: str, end_id: int, source: str) -> DataFrame:
    """Rows part, doc_id, queue, before (tokens of the queue earlier in the part), n, ids; written once."""
    def encode(batches):
        import os
        from array import array

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of = encoder(tokenizer_path(tokenizer))
        part = TaskContext.get().partitionId()
        seen: dict[str, int] = {}
        for batch in batches:
            own, queues = batch.column("doc_id").to_pylist(), batch.column("queue").to_pylist()
            for first, texts in text_slices(batch):
                rows = []
                for k, ids in enumerate(ids_of(texts), first):
                    ids.append(end_id)
                    n = len(ids)
                    before = seen.get(queues[k], 0)
                    seen[queues[k]] = before + n
                    rows.append((part, own[k], queues[k], before, n, array("I", ids).tobytes()))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "doc_id", "queue", "before", "n", "ids"])

    # null is a source of its own, and differs from the text ''
    queue = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), queue.alias("queue"))
    return written(rows.mapInArrow(encode, TOKENS), "mixture-tokens")


def pack_mixture(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, grain: int = 256, targets: Mapping[str | None, float] | None = None, source: str = "source", broadcast_rows: int = 200_000, max_sources: int = 10_000) -> DataFrame:
    """Packs all documents; rows doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32).

    targets: the share of each source in a window, on any scale; without them each
    source's share of all tokens, so that all queues run dry together. Every source of docs
    needs a positive target, else ValueError. A source that has run dry leaves
    its share to the others.

    A null text is empty and gives one end id; a very long text is cut where the
    stream breaks it. Repeated rows and null ids are packed like any other; ties do
    not occur, since the table's order decides. A null source is a queue of its own. An empty
    table gives no rows; other columns are ignored. More than max_sources sources raise
    ValueError: a mixture is a table that each task holds. The tokens before each part
    are broadcast up to broadcast_rows rows (parts times sources), else joined.
    """
    spark = docs.sparkSession
    tokens = token_table(docs, tokenizer, end_id, source)
    held = tokens.groupBy("queue", "part").agg(F.sum("n").alias("held"))
    totals = held.groupBy("queue").agg(F.sum("held").alias("n"), F.count("*").alias("parts")).orderBy("queue").limit(max_sources + 1).collect()
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    names = [r["queue"] for r in totals]
    amounts = [int(r["n"]) for r in totals]
    if targets is None:
        weights = amounts
    else:
        share = {"" if k is None else f"={k}": v for k, v in targets.items()}
        if bad := [q for q in names if not share.get(q, 0) > 0]:
            raise ValueError(f"no positive target for the sources {bad[:5]}")
        most = max((share[q] for q in names), default=1.0)
        weights = [max(1, round(share[q] / most * 10**9)) for q in names]
    number = {q: i for i, q in enumerate(names)}

    # a row for each part, not for each document, so one source is no large group
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("queue", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    small = sum(r["parts"] for r in totals) <= broadcast_rows
    placed = tokens.join(F.broadcast(bases) if small else bases, ["queue", "part"]).select("doc_id", "queue", (F.col("base") + F.col("before")).alias("first"), "n", "ids")

    def cut(batches):
        import pyarrow as pa

        rounds = Rounds(amounts, weights, capacity, grain) if names else None
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for doc, queue, first, n, ids in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    for start, length, sequence, offset in rounds.pieces(number[queue], first, n):
                        rows.append((doc, start, length, n, sequence, offset, ids[4 * start : 4 * (start + length)]))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return placed.mapInArrow(cut, PIECES) if names else spark.createDataFrame([], PIECES)
