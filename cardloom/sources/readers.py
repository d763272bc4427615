"""Readers of allowlists, responses, cards, state, failures and health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cardloom import schemas


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The allowlist, a JSON array in one file; max_entries is clamped to 1..50, and 50 where it is no integer.

    A document that is no list, or an item without a string name and url, raises.
    """
    from cardloom.functions.text import bounded

    doc = spark.read.option("wholetext", True).text(path).select(F.try_parse_json("value").alias("v"))
    is_list = F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False))
    items = doc.select(F.when(is_list, F.try_variant_get("v", "$", "array<variant>")).otherwise(F.raise_error(F.lit("sources: a list is expected"))).alias("items"))
    rows = items.select(F.posexplode("items").alias("source_ord", "v"))
    text = lambda f: F.when(F.coalesce(F.schema_of_variant(F.try_variant_get("v", f"$.{f}", "variant")) == "STRING", F.lit(False)), F.try_variant_get("v", f"$.{f}", "string")).otherwise(F.raise_error(F.lit(f"sources: {f} must be text")))
    whole = F.coalesce(F.schema_of_variant(F.try_variant_get("v", "$.max_entries", "variant")) == "BIGINT", F.lit(False))
    n = F.when(whole, F.least(F.greatest(F.try_variant_get("v", "$.max_entries", "long"), F.lit(1)), F.lit(schemas.MAX_ENTRIES))).otherwise(F.lit(schemas.MAX_ENTRIES))
    return rows.select("source_ord", bounded(text("name"), 120).alias("name"), bounded(text("url"), 2048).alias("url"), n.cast("int").alias("max_entries"))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Feed responses stored as Parquet."""
    return spark.read.schema(schemas.RESPONSES).parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Raw feed bodies, a file each."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(path).select(F.regexp_extract("path", r"([^/]+)\.xml$", 1).alias("raw_sha256"), "content")


def read_cards_raw(spark: SparkSession, path: str, broadcast_blocks: int = 200_000) -> DataFrame:
    """Rows file, line_no, line, v of JSON-lines cards; v is null where a line is no JSON.

    Line numbers come from each block's place in its file: the order of a block's
    rows is that of its scan ids, and the blocks before it give the offset. The
    blocks are counted in the same query, since ids hold within one; up to broadcast_blocks of them are sent to the
    lines, which then stay where they are read.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    blocks = lines.groupBy("file", "block").agg(F.min("n").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    # a file gives one block more than the partitions that it fills, at most
    few = len(lines.inputFiles()) + lines.rdd.getNumPartitions() <= broadcast_blocks
    joined = lines.join(F.broadcast(blocks) if few else blocks, ["file", "block"])
    return joined.select("file", (F.col("before") + F.col("n") - F.col("first") + 1).alias("line_no"), "line", F.try_parse_json("line").alias("v"))


def classify_lines(raw: DataFrame) -> DataFrame:
    """raw with kind: blank_line, malformed_jsonl, card_type (JSON but no object) or card."""
    blank = F.trim(F.regexp_replace("line", r"(?U)\s", "")) == ""
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    return raw.withColumn("kind", F.when(blank, "blank_line").when(F.col("v").isNull(), "malformed_jsonl").when(~is_object, "card_type").otherwise("card"))


def existing_ids(raw: DataFrame) -> DataFrame:
    """Distinct ids of stored cards; lines without a text id are passed over."""
    is_text = F.schema_of_variant(F.try_variant_get("v", "$.id", "variant")) == "STRING"
    return raw.where(is_text).select(F.try_variant_get("v", "$.id", "string").alias("id")).distinct()


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet rows of the schema; no rows where there is no such table or it has other columns."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        df = None
    wanted = T.StructType.fromDDL(schema)
    if df is None or not set(wanted.names) <= set(df.columns):
        return spark.createDataFrame([], wanted)
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, schemas.STATE)


def valid_health(df: DataFrame) -> DataFrame:
    """Health rows with a streak of at least 1 and all texts present."""
    texts = [F.col(c).isNotNull() for c in ("source_url", "source_name", "first_failed_at", "last_reason")]
    keep = F.col("consecutive_failures") >= 1
    for t in texts:
        keep = keep & t
    return df.where(keep)


def read_health(spark: SparkSession, path: str) -> DataFrame:
    return valid_health(_read_or_empty(spark, path, schemas.HEALTH))


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """Failures of a collection summary (one JSON object in a file); entries of other types are dropped."""
    doc = spark.read.option("wholetext", True).text(path).select(F.try_parse_json("value").alias("v"))
    rows = doc.select(F.posexplode(F.try_variant_get("v", "$.failures", "array<variant>")).alias("ord", "f"))
    fields = ("source_name", "source_url", "reason")
    typed = [F.schema_of_variant(F.try_variant_get("f", f"$.{k}", "variant")) == "STRING" for k in fields]
    keep = typed[0] & typed[1] & typed[2]
    return rows.where(F.coalesce(keep, F.lit(False))).select("ord", *[F.try_variant_get("f", f"$.{k}", "string").alias(k) for k in fields])
