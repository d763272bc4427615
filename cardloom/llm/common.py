"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, A_Z, A_Z.lower())


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id's text, modulo n; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes df to the cluster's checkpoint folder and reads it from there.

    The folder is the session's spark.checkpoint.dir; where that is unset (tests
    on one machine) it lies in the warehouse, which executors share too.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        context.setCheckpointDir(at or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or where that is unset the warehouse."""
    conf = spark.sparkContext.getConf()
    return spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as compressed Parquet to the shared folder and read from there; for rows of many bytes."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int, each: int = 30_000) -> DataFrame:
    """df, of at most `rows` rows, in no more partitions than they fill; many near-empty ones only cost files."""
    return df.coalesce(max(1, -(-rows // each)))


def bounded_sample(df: DataFrame, label: str, limits: dict, key: str = "doc_id") -> DataFrame:
    """About limits[value] rows for each value of label, at most twice that many in all.

    Rows are chosen by a hash of the key, so the choice does not depend on
    partitioning. The counts are taken over all rows.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect() if r[0] in limits}
    if not counts:
        return df.limit(0)
    u = (F.xxhash64(F.col(key).cast("string"), F.lit("sample")).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, limits[k] / max(n, 1))))])
    rows = df.where(F.col(label).isin(list(counts))).where(u < share[F.col(label)])
    return rows.limit(2 * sum(limits[k] for k in counts))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, limits: dict) -> list:
    """Collects doc_id, text and label of a bounded sample of the labels, ordered by id.

    The sample is drawn from the labels alone, so that only chosen documents'
    texts leave their partitions; its size is bounded by the limits, which makes
    it fit to broadcast.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    chosen = bounded_sample(one, label, limits)
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").collect()
    return sorted(rows, key=lambda r: (r["doc_id"], r["text"]))


def fit_logistic(x, y, weight=None, l2: float = 1e-3, steps: int = 60):
    """Damped Newton's method for a small logistic regression; returns weights, the last is the bias."""
    import numpy as np

    x = np.hstack([np.asarray(x, float), np.ones((len(x), 1))])
    y = np.asarray(y, float)
    w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
    w = w / w.mean()
    b = np.zeros(x.shape[1])
    ridge = l2 * len(y) * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9

    def loss(b):
        z = x @ b
        return (w * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * b @ ridge @ b

    now = loss(b)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (p - y)) + ridge @ b
        h = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, g)
        while np.abs(step).max() > 1e-9 and (then := loss(b - step)) > now:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        b, now = b - step, then
    return b


def text_slices(batch, column: str = "text", chars: int = 4_000_000):
    """(first, texts) parts of a record batch, each of few enough characters; null is ''."""
    texts = [t or "" for t in batch.column(column).to_pylist()]
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts[first:]:
        yield first, texts[first:]
