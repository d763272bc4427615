"""Line dedup over levelled sorted runs of line hashes.

Batches of documents come in descending order of their ids. A run holds, sorted
and bucketed by the hash of a line's key, the number of documents of a batch that
have the line and the largest id among them. Each batch is merge-anti-joined with
each run's settled lines (those that the run has seen in enough documents; their
largest id is known, since later batches hold smaller ids) and adds a run of the
rest. Once a level holds `fanout` runs, they are merged into one run of the next
level, by full outer merge joins of two. All runs are bucketed alike, so neither a
batch's anti-joins nor a merge shuffles a run; only a batch's own counts are
shuffled, once.

A line's key is the line stripped of ASCII white space, A-Z lower-cased.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut_lineage, lower_ascii

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3


def lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows doc_id, th (hash of the whole text), pos, h: a 128-bit hash of each key of at least min_chars code points.

    Rows with a null doc_id have no lines here and so never lose any.
    """
    rows = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    # stripping and lower-casing add no code points
    keyed = rows.where(F.length("line") >= min_chars).select("doc_id", "th", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc_id", "th", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("h"))


def line_counts(lines_: DataFrame) -> DataFrame:
    """Rows h, n_docs, max_doc for rows of long_lines; a line counts once for a document."""
    own = lines_.select("h", "doc_id").distinct()
    return own.groupBy("h").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))


class LineRuns:
    """The levelled runs, as bucketed tables of the session's warehouse."""

    def __init__(self, spark: SparkSession, buckets: int = 32, fanout: int = 2, min_docs: int = MIN_DOCS):
        self.spark, self.buckets, self.fanout, self.min_docs = spark, buckets, max(2, fanout), min_docs
        self.levels: list[list[str]] = []
        self.compactions = 0

    def _write(self, run: DataFrame, level: int) -> None:
        # run is partitioned by h already: each bucket's rows lie in few tasks
        name = f"line_run_{uuid.uuid4().hex}"
        run.write.bucketBy(self.buckets, "h").sortBy("h").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _names(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def merged(self, one: str, two: str) -> DataFrame:
        """The run of two runs' lines, joined bucket by bucket."""
        other = self.spark.table(two).select("h", F.col("n_docs").alias("more"), F.col("max_doc").alias("top"))
        both = self.spark.table(one).join(other.hint("merge"), "h", "full")
        zero = F.lit(0).cast("long")
        return both.select("h", (F.coalesce("n_docs", zero) + F.coalesce("more", zero)).alias("n_docs"), F.greatest("max_doc", "top").alias("max_doc"))

    def _compact(self, names: list[str], level: int) -> None:
        """Puts one run of `level` in place of the runs named, merging two at a time."""
        while len(names) > 1:
            one, two, *rest = names
            self._write(self.merged(one, two), level)
            self.levels = [[n for n in x if n not in (one, two)] for x in self.levels]
            self._drop([one, two])
            names = [self.levels[level][-1], *rest]
        self.compactions += 1

    def seen(self) -> DataFrame:
        """One row for each hash in any run: the runs are merged into one, small ones first."""
        names = self._names()
        if not names:
            return self.spark.createDataFrame([], "h binary, n_docs long, max_doc long")
        if len(names) > 1:
            self._compact(names, len(self.levels) - 1)
        return self.spark.table(self._names()[0])

    def frequent(self) -> DataFrame:
        """Rows h, max_doc of the lines in at least min_docs documents."""
        return self.seen().where(F.col("n_docs") >= self.min_docs).select("h", "max_doc")

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """A batch's counts without the lines that a run has settled: a merge anti-join with each run."""
        if counts.sparkSession.conf.get("spark.sql.shuffle.partitions") != str(self.buckets):
            counts = counts.repartition(self.buckets, "h")  # else the counts' own shuffle has the buckets' number
        for name in self._names():
            settled = self.spark.table(name).where(F.col("n_docs") >= self.min_docs).select("h", F.lit(True).alias("settled"))
            # an anti-join written as one would be moved below the counting, and shuffle a hot line's rows one by one
            counts = counts.join(settled.hint("merge"), "h", "left").where("settled is null").drop("settled")
        return counts

    def add(self, batch: DataFrame) -> None:
        """Adds the run of a batch (rows of long_lines), all of whose ids are below those before. Compacts full levels."""
        self._write(self.unsettled(line_counts(batch)), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self._compact(list(self.levels[level]), level + 1)
            level += 1

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")

    def close(self) -> None:
        self._drop(self._names())
        self.levels = []


def id_batches(rows: DataFrame, n: int) -> list[DataFrame]:
    """rows in at most n batches of about equal size and descending doc_id; no doc_id is in two."""
    borders = rows.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / n) for i in range(1, n)]), 10_000)).first()[0] if n > 1 else None
    borders = sorted(set(borders or []))
    out, high = [], None
    for low in [*reversed(borders), None]:
        own = F.lit(True) if low is None else F.col("doc_id") > low
        out.append(rows.where(own if high is None else own & (F.col("doc_id") <= high)))
        high = low
    return out


def dedup_lines(docs: DataFrame, batches: int = 4, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, buckets: int | None = None) -> DataFrame:
    """Drops lines in at least min_docs documents everywhere but in the largest doc_id.

    Keeps all columns of docs, with text replaced by what stays (lines joined by
    newlines; the empty string if none) and n_lines, n_dropped appended. Null
    and empty texts are one empty line and keep it. Repeated rows of one doc_id
    count as one document and lose the same lines. Null doc_ids lose none. Very
    long texts are split whole, a row for each long line. An empty table gives an
    empty table. Columns of other names pass through.
    """
    spark = docs.sparkSession
    found = cut_lineage(long_lines(docs.select("doc_id", "text"), min_chars))
    runs = LineRuns(spark, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), min_docs=min_docs)
    try:
        for batch in id_batches(found, batches):
            runs.add(batch)
        frequent = cut_lineage(runs.frequent())
    finally:
        runs.close()

    # positions, not lines, travel back to the documents
    dropped = found.join(frequent, "h").where("doc_id < max_doc")
    by_doc = dropped.groupBy(F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).agg(F.collect_set("pos").alias("__drop"))
    own, n = lines(F.col("text")), F.size(lines(F.col("text")))
    keep = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__drop"))
    joined = docs.join(by_doc, (F.col("doc_id") == F.col("__doc")) & (F.xxhash64("text") == F.col("__th")), "left")
    cut = joined.withColumns({"n_lines": n.cast("long"), "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long")})
    cut = cut.withColumn("n_dropped", F.greatest("n_dropped", F.lit(0).cast("long")))
    text = F.when(F.col("__drop").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(F.transform(keep, lambda i: F.get(own, i)), "\n"))
    return cut.withColumn("text", text).drop("__doc", "__th", "__drop")
