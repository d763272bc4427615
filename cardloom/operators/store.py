"""The collecting store: tables written by batches, a ledger of the batches, and filters of the cards' ids.

A batch writes its cards, id filters, snapshots, state, failures and summary to folders
of its own, and last its number to the ledger. Readers see only batches in the ledger, and a batch
that is run again replaces its folders, so all of it appears once or not at all.

Cards lie in buckets by a hash of their id. Each bucket has a Bloom filter, in
segments of 32,768 bits, which is persisted with the batch; a new batch asks the filters of its own ids
and opens only buckets that may hold one of them. The buckets it opens decide, so
that a filter's mistake costs a look and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom import schemas
from cardloom.operators import collect
from cardloom.sources import commits

SNAPSHOTS = "raw_sha256 string, content binary"
SUMMARY = "sources_total long, sources_fetched long, sources_not_modified long, sources_failed long, cards_added long, cards_skipped long, snapshots_added long"
FAILURES = "source_ord int, source_name string, source_url string, reason string"
TABLES = {"cards": f"{schemas.CARD}, bucket int", "filters": "bucket int, segment int, bits binary", "snapshots": SNAPSHOTS, "state": schemas.STATE, "failures": FAILURES, "summary": SUMMARY}
COMPACTED = ("cards", "filters", "snapshots", "state")
SEGMENT_BITS, HASHES = 32_768, 4


class Store:
    """A store below a path. buckets and segments are fixed when it is first written to.

    segments: Bloom segments of a bucket; about 3,000 ids a segment keep false
    positives near one in eighty.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256, segments: int = 4):
        import json

        self.spark, self.path = spark, path
        if commits.claim(spark, f"{path}/layout.claim"):
            commits.put_text(spark, f"{path}/layout/layout.json", json.dumps({"buckets": buckets, "segments": segments}))
        own = spark.read.schema("buckets int, segments int").json(f"{path}/layout").first()
        self.buckets, self.segments = own["buckets"], own["segments"]

    # ---- the ledger

    def batches(self) -> list[int]:
        """Numbers of all batches that are whole; compacted ones are negative."""
        return sorted(int(n.removesuffix(".json")) for n in commits.names(self.spark, f"{self.path}/ledger") if n.endswith(".json"))

    def live(self) -> list[int]:
        """Whole batches whose tables no compacted batch replaces."""
        whole = self.batches()
        if not whole or whole[0] >= 0:
            return whole
        gone = self.spark.read.schema("replaces array<long>").json(f"{self.path}/ledger").select(F.explode("replaces").alias("b"))
        return sorted({*whole} - {r["b"] for r in gone.collect()})

    def table(self, name: str) -> DataFrame:
        """The rows of a table in all whole batches, with their batch."""
        wanted = T.StructType.fromDDL(TABLES[name] + ", batch long")
        there = {int(n.removeprefix("batch=")) for n in commits.names(self.spark, f"{self.path}/{name}")}
        whole = [b for b in (self.live() if name in COMPACTED else self.batches()) if b in there]
        if not whole:
            return self.spark.createDataFrame([], wanted)
        # a schema of its own, so that no file is opened to find one
        return self.spark.read.schema(wanted).parquet(f"{self.path}/{name}").where(F.col("batch").isin(whole)).select(*wanted.names)

    def state(self) -> DataFrame:
        """The collector's state: for each source the row of its last batch."""
        cols = [c for c in schemas.names(schemas.STATE) if c != "source_url"]
        last = self.table("state").groupBy("source_url").agg(F.max_by(F.struct(*cols), "batch").alias("r"))
        return last.select("source_url", "r.*")

    # ---- ids

    def bucket(self, id_: Column) -> Column:
        return F.pmod(F.xxhash64(id_), F.lit(self.buckets)).cast("int")

    def _bits(self, ids: DataFrame) -> DataFrame:
        """Rows id, bucket, segment, bit: the places of each id in its bucket's filter."""
        places = F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(self.segments * SEGMENT_BITS)) for k in range(1, HASHES + 1)])
        rows = ids.select("id", self.bucket(F.col("id")).alias("bucket"), F.explode(places).alias("place"))
        return rows.select("id", "bucket", F.expr(f"cast(place div {SEGMENT_BITS} as int)").alias("segment"), (F.col("place") % SEGMENT_BITS).alias("bit"))

    def filters_of(self, ids: DataFrame) -> DataFrame:
        return self._bits(ids).groupBy("bucket", "segment").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def may_hold(self, ids: DataFrame) -> DataFrame:
        """Rows id, bucket of the ids that the filters do not rule out."""
        filters = self.table("filters").groupBy("bucket", "segment").agg(F.bitmap_or_agg("bits").alias("bits"))
        byte = F.expr("cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)")
        held = byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
        hits = self._bits(ids).join(filters, ["bucket", "segment"]).where(held)
        # two hashes of an id may fall on one place, which counts for both
        return hits.groupBy("id", "bucket").agg(F.count("*").alias("n")).where(F.col("n") == HASHES).select("id", "bucket")

    def known(self, ids: DataFrame) -> DataFrame:
        """The stored ids in those buckets that may hold any of ids (distinct); other buckets are not read."""
        wanted = sorted(r["bucket"] for r in self.may_hold(ids).select("bucket").distinct().collect())
        return self.table("cards").where(F.col("bucket").isin(wanted)).select("id")

    # ---- writing

    def compact(self) -> None:
        """One batch in place of all there are, seen once it is in the ledger; summaries and failures stay by batch.

        Folders that an earlier compaction has replaced go now, so that readers have had a whole
        interval to finish.
        """
        live, whole = self.live(), self.batches()
        if len(live) < 2:
            return
        number = min(0, whole[0]) - 1
        merged = {
            "cards": self.table("cards"), "snapshots": self.table("snapshots"), "state": self.state(),
            "filters": self.table("filters").groupBy("bucket", "segment").agg(F.bitmap_or_agg("bits").alias("bits")),
        }
        for name, df in merged.items():
            self.write(name, number, df)
        commits.put_text(self.spark, f"{self.path}/ledger/{number}.json", '{"replaces": %s}' % live)
        for b in {*whole} - {*live}:
            for name in COMPACTED:
                commits.drop(self.spark, f"{self.path}/{name}/batch={b}")

    def write(self, name: str, batch: int, df: DataFrame) -> None:
        """Replaces a batch's own part of a table; unseen until the batch is in the ledger."""
        wanted = [c for c in T.StructType.fromDDL(TABLES[name]).names]
        rows = df.select(*wanted)
        if name == "cards":
            rows = rows.repartition("bucket")
        out = rows.write.mode("overwrite")
        (out.partitionBy("bucket") if name == "cards" else out).parquet(f"{self.path}/{name}/batch={batch}")

    def commit(self, batch: int) -> None:
        commits.put_text(self.spark, f"{self.path}/ledger/{batch}.json", "{}")

    def add_cards(self, batch: int, cards: DataFrame) -> None:
        """Writes new cards and the filters of their ids; commit makes both visible."""
        self.write("cards", batch, cards.withColumn("bucket", self.bucket(F.col("id"))))
        own = self.spark.read.schema(TABLES["cards"]).parquet(f"{self.path}/cards/batch={batch}")
        self.write("filters", batch, self.filters_of(own.select("id")))


def collect_batch(store: Store, batch: int, responses: DataFrame, sources: DataFrame) -> DataFrame:
    """One whole collecting run; returns its summary row.

    Cards are written only where there are new ones, before snapshots and state, and state
    only where something was fetched; failures and the summary follow, and the ledger last.
    A batch in the ledger is not run again. Parsed responses are
    written once, so that bodies are parsed once.
    """
    spark = store.spark
    if batch not in store.batches():
        staged = f"{store.path}/staged/batch={batch}"
        collect.parse_responses(collect.classify_responses(responses, sources)).write.mode("overwrite").parquet(staged)
        got = spark.read.parquet(staged)
        cards = collect.first_of_batch(collect.build_cards(collect.entries_of_batch(got)))
        cards.write.mode("overwrite").parquet(f"{staged}-cards")
        cards = spark.read.parquet(f"{staged}-cards")
        for name in TABLES:  # what a run that failed has left
            commits.drop(spark, f"{store.path}/{name}/batch={batch}")
        new = cards.join(store.known(cards.select("id")), "id", "left_anti")
        if not new.isEmpty():
            store.add_cards(batch, new)
        store.write("snapshots", batch, collect.new_snapshots(got, store.table("snapshots")))
        state = collect.fetched_state(got)
        if not state.isEmpty():
            store.write("state", batch, state)
        store.write("failures", batch, collect.failures(got))
        n = spark.read.schema(SNAPSHOTS).parquet(f"{store.path}/snapshots/batch={batch}")
        parsed = collect.entries_of_batch(got)
        store.write("summary", batch, collect.collection_summary(got, parsed, new, n))
        store.commit(batch)
        commits.drop(spark, staged)
        commits.drop(spark, f"{staged}-cards")
    return store.table("summary").where(F.col("batch") == batch)
