"""Continuous collecting and health with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cardloom import schemas
from cardloom.operators.store import Store, collect_batch


def stream_collect(spark: SparkSession, in_dir: str, sources: DataFrame, store: str, checkpoint: str, files_a_batch: int = 100):
    """Starts a query that collects new response files into the store, a whole run for each micro-batch.

    A batch's number is its number in the store's ledger, so a batch that is
    killed and replayed appears once. Each is compared with the store's
    buckets that may hold its ids, so the first version of a card wins at any distance.
    Sources that have no response in a batch are not judged by it.
    """
    own = Store(spark, store)

    def add(batch: DataFrame, number: int) -> None:
        asked = sources.join(batch.select(F.col("source_url").alias("url")).distinct(), "url", "left_semi").select(*sources.columns)
        collect_batch(own, number, batch, asked)

    responses = spark.readStream.schema(schemas.RESPONSES).option("maxFilesPerTrigger", files_a_batch).parquet(in_dir)
    return responses.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Streaks(StatefulProcessor):
    """A source's streak: its length, first failure, name, and the last run it was seen in.

    A failure sets a timer at its run's time, which fires once the watermark, that is
    a later run, has passed it. A source that had no row in that run has recovered; one that
    failed again has moved its timer.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.streak = handle.getValueState("streak", "n int, first string, name string, run long, at long")

    def handleInputRows(self, key, rows, timerValues):
        n, first, name, seen, at = self.streak.get() if self.streak.exists() else (0, None, None, None, None)
        timer, last = at if n else None, None
        # several failures of one run count once, the last by ord
        for r in sorted(rows, key=lambda r: (r["run_no"], r["ord"])):
            if seen is not None and (r["run_no"] < seen or (r["run_no"] == seen and not r["failed"])):
                continue
            again = r["run_no"] == seen and n > 0
            if r["failed"] and not again:
                # runs are numbered without gaps, so a gap is a run without a failure
                n, first = (n + 1, first) if n and r["run_no"] == seen + 1 else (1, r["failed_at"])
            elif not r["failed"]:
                n, first = 0, None
            name, seen, at, last = r["source_name"], r["run_no"], int(r["run_at"].timestamp() * 1000), r
        if last is None:
            return
        if timer is not None:
            self.handle.deleteTimer(timer)
        if n:
            self.handle.registerTimer(at)
        self.streak.update((n, first, name, seen, at))
        yield Row(source_url=key[0], source_name=name, consecutive_failures=n, first_failed_at=first, last_reason=last["reason"] if n else None, run_no=seen)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n, _, name, seen, at = self.streak.get()
        if n and at == expiredTimerInfo.getExpiryTimeInMs():
            self.streak.update((0, None, name, seen + 1, at))
            yield Row(source_url=key[0], source_name=name, consecutive_failures=0, first_failed_at=None, last_reason=None, run_no=seen + 1)

    def close(self) -> None:
        pass


def stream_health(outcomes: DataFrame) -> DataFrame:
    """Streaks over a stream of source_url, source_name, run_no, run_at, failed, failed_at, reason, ord.

    run_no counts runs without gaps; run_at is the run's time, the same in all its rows, and runs are
    more than a second apart. A run's rows come no later than in the micro-batch of the next run. A source without a row in a run did not fail
    there; each run has a row of some source. Gives a source's state (with run_no, the run it
    holds after) whenever it changes; a streak of 0 means recovered. The latest run_no of a source counts.
    The session's state store provider must be RocksDB's.
    """
    spark = outcomes.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    rows = outcomes.withWatermark("run_at", "1 second").groupBy("source_url")
    return rows.transformWithState(Streaks(), f"{schemas.HEALTH}, run_no long", "Update", "eventTime")


def health_after(states: DataFrame) -> DataFrame:
    """The failing sources after all that stream_health has given so far."""
    cols = [c for c in schemas.names(schemas.HEALTH) if c != "source_url"]
    last = states.groupBy("source_url").agg(F.max_by(F.struct(*cols), F.struct("run_no", F.col("consecutive_failures") == 0)).alias("s"))
    return last.select("source_url", "s.*").where("consecutive_failures > 0")
