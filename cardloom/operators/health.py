"""Source health: streaks of failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardloom.schemas import DEFAULT_THRESHOLD


def failures_of_run(failures: DataFrame) -> DataFrame:
    """One row a source: of several failures in one run the last (by ord) counts."""
    last = failures.groupBy("source_url").agg(F.max_by(F.struct("source_name", "reason"), "ord").alias("f"))
    return last.select("source_url", "f.source_name", "f.reason")


def fold_health(previous: DataFrame, failures: DataFrame, now: str) -> DataFrame:
    """The next state: failing sources with their streak one longer; others leave it."""
    f = failures_of_run(failures).withColumnRenamed("source_name", "name")
    p = previous.select("source_url", "consecutive_failures", "first_failed_at")
    joined = f.join(p, "source_url", "left")
    return joined.select(
        "source_url", F.col("name").alias("source_name"), (F.coalesce("consecutive_failures", F.lit(0)) + 1).cast("int").alias("consecutive_failures"),
        F.coalesce("first_failed_at", F.lit(now)).alias("first_failed_at"), F.col("reason").alias("last_reason"),
    )


def health_report(state: DataFrame, previous: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Rows source_url, status (unhealthy, degraded or recovered), consecutive_failures, source_name, first_failed_at, last_reason, by URL.

    A recovered source keeps the name, time and reason of the streak that ended.
    """
    least = max(1, threshold)
    rest = ("source_name", "first_failed_at", "last_reason")
    now = state.select("source_url", F.when(F.col("consecutive_failures") >= least, "unhealthy").otherwise("degraded").alias("status"), "consecutive_failures", *rest)
    gone = previous.join(state, "source_url", "left_anti").select("source_url", F.lit("recovered").alias("status"), F.lit(0).alias("consecutive_failures"), *rest)
    return now.unionByName(gone).orderBy("source_url")


def health_counts(report: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """One row of a health_report: the threshold used, failing sources in all, and sources by status."""
    n = lambda *kinds: F.count_if(F.col("status").isin(*kinds))
    return report.agg(
        F.lit(max(1, threshold)).alias("threshold"), n("unhealthy", "degraded").alias("total_failing"), n("unhealthy").alias("unhealthy"), n("degraded").alias("degraded"), n("recovered").alias("recovered"),
    )


#: Streak summaries folded at once; three levels hold 10^8 runs of a source.
FANOUT = 512


def streak(run, failed_at, last) -> Column:
    """The summary of one failing run. Summaries of later and earlier runs merge, in order, to that of all.

    first, last: the first and last failing run; prefix, suffix: how many failing runs
    begin and end it without a gap; since: when the suffix began; row: what the last run tells.
    """
    one = F.lit(1).cast("long")
    return F.struct(run.alias("first"), run.alias("last"), one.alias("prefix"), one.alias("suffix"), failed_at.alias("since"), last.alias("row"))


def merged(a: Column, b: Column) -> Column:
    """The summary of both, all of a's runs being before b's."""
    touch = b["first"] == a["last"] + 1
    whole = lambda s: s["suffix"] == s["last"] - s["first"] + 1
    longer = touch & whole(b)
    return F.struct(
        a["first"].alias("first"), b["last"].alias("last"), F.when(touch & whole(a), a["prefix"] + b["prefix"]).otherwise(a["prefix"]).alias("prefix"),
        F.when(longer, a["suffix"] + b["suffix"]).otherwise(b["suffix"]).alias("suffix"), F.when(longer, a["since"]).otherwise(b["since"]).alias("since"), b["row"].alias("row"),
    )


def folded_streaks(rows: DataFrame, last_run: int) -> DataFrame:
    """Rows source_url, s: one summary a source, from a row for each failing run (source_url, k, s).

    Runs are folded by ranges of FANOUT, these by ranges again, and so on, so that no step holds
    more of a source's history than FANOUT summaries.
    """
    span = 1
    while True:
        span *= FANOUT
        ranges = F.expr(f"k div {span}")
        own = rows.groupBy("source_url", ranges.alias("k_")).agg(F.array_sort(F.collect_list("s")).alias("a"))
        fold = F.aggregate(F.expr("slice(a, 2, greatest(size(a) - 1, 0))"), F.get("a", 0), merged)
        rows = own.select("source_url", (F.col("k_") * span).alias("k"), fold.alias("s"))
        if span > last_run:
            return rows.select("source_url", "s")


def health_streaks(outcomes: DataFrame, runs: DataFrame) -> DataFrame:
    """The state after the last run, from a history.

    outcomes: run_no, source_url, source_name, failed, failed_at, reason, ord (a
    source without a row in a run did not fail there); runs: the dense list of
    run_no. Rows are first reduced to one a source and run. A streak starts after
    the last run before it without a failure.
    """
    one = outcomes.where("failed").groupBy("source_url", "run_no").agg(F.max_by(F.struct("source_name", "failed_at", "reason"), "ord").alias("f"))
    # runs are few beside outcomes: one number for each, by a window over them alone
    numbered = runs.select("run_no").distinct().select("run_no", F.row_number().over(Window.orderBy("run_no")).cast("long").alias("k"))
    last = numbered.agg(F.max("k")).first()[0] or 0
    rows = one.join(numbered, "run_no").select("source_url", "k", streak(F.col("k"), F.col("f.failed_at"), F.col("f")).alias("s"))
    alive = folded_streaks(rows, last).where(F.col("s.last") == last)
    return alive.select("source_url", F.col("s.row.source_name").alias("source_name"), F.col("s.suffix").cast("int").alias("consecutive_failures"), F.col("s.since").alias("first_failed_at"), F.col("s.row.reason").alias("last_reason"))
