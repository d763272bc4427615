"""A training corpus from `documents`: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage works on what the one before it kept, and all but the last return
the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import decontam, linededup, neardup, packing, toxicity
from cardloom.llm.common import cut_lineage, table
from cardloom.llm.queries import TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3; the labels are those of the input folder.

    A row is judged by its id and text, so rows with a null id or a repeated id
    are judged each by their own text. Null and empty texts have no toxic clause
    and stay. An empty table gives an empty table; other columns pass through.
    """
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    bad = toxicity.score_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("__key")), table(spark, sf_dir, "labels")).where("score >= 0.3")
    bad = bad.select(F.col("doc_id").alias("__doc"), F.col("__key").alias("__bad")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("__key").eqNullSafe(F.col("__bad"))
    return keyed.join(bad, same, "left_anti").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; n_chars follows the text, and none is dropped.

    A null text becomes the empty one. Rows with a null id lose no line; repeated
    rows lose the same ones. An empty table gives an empty table; other columns
    pass through.
    """
    cut = linededup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id.

    Repeated rows of one id are one document and stay or go together. Null and
    empty texts, and rows with a null id, are in no group and stay. An empty table
    gives an empty table; other columns pass through.
    """
    groups = cut_lineage(neardup.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct())
    return docs.join(groups, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows.

    Null and wordless texts stay; rows with a null id and repeated rows are judged
    like any other. An empty table gives an empty table; other columns pass through.
    """
    judged = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return judged.where("not contaminated").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; a row for each piece of a document.

    A null text is empty and gives one piece; repeated rows and null ids give
    pieces of their own. An empty table gives no rows; other columns are ignored.
    """
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None  # the toxicity model and the packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages; each result but the last is written and read again, in the shared folder.

    Folders of stages before the last one read are removed as soon as the next is written.
    """
    docs = table(spark, sf_dir, "documents")
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    run_id, before = uuid.uuid4().hex, None
    for name, stage in STAGES[:-1]:
        path = f"{at}/corpus-{run_id}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a stage's folder with the file system that Spark itself writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
