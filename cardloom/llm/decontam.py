"""Benchmark decontamination as a prefix-filtered set join.

A window is 13 consecutive words of a benchmark item (a shorter item is one
window). A document holds a window only if it holds each of its 3-word
shingles, so it is enough to look for the one that is rarest in the corpus: the
window's prefix under the order by rarity. A first pass over the documents
counts the benchmark's shingles (partial sums, no places); a second joins the
prefixes alone. Where a document has a prefix, the window's place follows from
the shingle's place in it; the length and position bounds drop places that stick
out of the document, and the words at the place are compared with the window's.
Windows of equal words are one window; which items own it is looked up for
windows that were found, apart from their places.

Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import cut_lineage, lower_ascii

WINDOW, SHINGLE = 13, 3
BROADCAST_ROWS = 200_000  # most rows (of shingles, windows or places, each at most a window long) to send to every executor


def words(text: Column) -> Column:
    """A text's words: runs of a-z, 0-9 and everything beyond ASCII, A-Z lower-cased; null has none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """How many words a text has, counted without lower-casing it."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")).cast("long")


def once(value: Column, f) -> Column:
    """f(value), with value computed once a row however often f reads it."""
    return F.get(F.transform(F.array(value), f), 0)


def shingle_hashes(w: Column, n: Column, k: int) -> Column:
    """Hashes of the k-word shingles of an array of n words, by position."""
    at = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(k), *[F.get(w, i + d) for d in range(k)]))


def united(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def sent(rows: DataFrame, n: int | None = None) -> DataFrame:
    """rows, marked for broadcast where they (or the n rows they were made of) are few enough; else joins shuffle."""
    return F.broadcast(rows) if (rows.count() if n is None else n) <= BROADCAST_ROWS else rows


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows item_id, s, w (the window's words); items without words have none."""
    items = benchmark.where("item_id is not null").select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    return items.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", "s", F.slice("w", F.col("s") + 1, window).alias("w"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256, contaminated appended.

    A null or wordless text has no words and is not contaminated. Repeated rows
    get equal results; rows with a null doc_id are judged like any other. Null
    item ids are left out; an empty benchmark contaminates nothing; an empty
    documents table gives an empty one. Columns of other names pass through.
    """
    none = F.lit(0).cast("long")
    n_words = word_count(F.col("text"))
    rows = cut_lineage(benchmark_windows(benchmark, window).select("item_id", F.unhex(F.md5(F.array_join("w", " ").cast("binary"))).alias("wid"), "w"))
    owners = rows.select("wid", "item_id").distinct()
    sizes = [r[0] for r in rows.select(F.least(F.size("w"), F.lit(shingle)).alias("k")).distinct().collect()]  # at most `shingle` values
    if not sizes:
        return docs.withColumns({"n_words": n_words, "n_hit": none, "n_items": none, "items_sha256": F.sha2(F.lit(""), 256), "contaminated": F.lit(False)})
    single = rows.select("wid", "w").dropDuplicates(["wid"])
    plain = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w"))

    def hashes(k):
        return shingle_hashes(F.col("w"), F.size("w"), k)

    parts = cut_lineage(united(single.where(F.least(F.size("w"), F.lit(shingle)) == k).select("wid", "w", F.lit(k).alias("k"), F.posexplode(hashes(k)).alias("p", "h")) for k in sizes))
    tokens = sent(cut_lineage(parts.select("k", "h").distinct()))
    rarity = united(plain.select(F.explode(hashes(k)).alias("h")).join(tokens.where(F.col("k") == k).select("h"), "h", "left_semi") for k in sizes).groupBy("h").agg(F.count("*").alias("df"))
    # a window with a shingle that no document has occurs nowhere
    rarest = parts.join(rarity, "h", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("df", none).alias("df"), "p", "h", "k", "w")).alias("least")).where("least.df > 0")
    prefix = cut_lineage(rarest.select("wid", "least.p", "least.h", "least.k", "least.w"))
    near = sent(prefix.select("wid", "p", "h", "k", F.size("w").alias("size")))
    at = F.col("at") - F.col("p")
    places = cut_lineage(united(
        plain.select("doc_id", "th", F.size("w").alias("n"), F.posexplode(hashes(k)).alias("at", "h")).join(near.where(F.col("k") == k), "h")
        .where((at >= 0) & (at + F.col("size") <= F.col("n"))).select("doc_id", "th", at.alias("at"), "wid")
        for k in sizes
    ))

    # the words of documents that have places are compared there
    of_doc = places.join(sent(prefix.select("wid", "w")), "wid").groupBy(F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).agg(F.collect_set(F.struct("at", "wid", "w")).alias("c"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.xxhash64("text").eqNullSafe(F.col("__th"))
    read = docs.select("doc_id", "text").join(sent(of_doc, places.count()), same)
    true = once(words(F.col("text")), lambda w: F.filter("c", lambda c: F.slice(w, c["at"] + 1, F.size(c["w"])) == c["w"]))
    hit = lambda c: F.size(F.array_distinct(F.flatten(F.transform(c, lambda x: F.sequence(x["at"], x["at"] + F.size(x["w"]) - 1)))))
    found = once(true, lambda c: F.struct(hit(c).cast("long").alias("hit"), F.array_distinct(F.transform(c, lambda x: x["wid"])).alias("wids")))
    read = cut_lineage(read.select("__doc", "__th", found.alias("c")))
    held = read.select("__doc", "__th", F.col("c.hit").alias("__hit"), F.explode("c.wids").alias("wid"))
    judged = held.join(sent(owners), "wid").groupBy("__doc", "__th", "__hit").agg(F.collect_set("item_id").alias("items"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    judged = cut_lineage(judged.select("__doc", "__th", "__hit", F.size("items").cast("long").alias("__n"), F.sha2(ids, 256).alias("__sha")))

    out = docs.join(sent(judged), same, "left").withColumns({
        "n_words": n_words,
        "n_hit": F.coalesce("__hit", none),
        "n_items": F.coalesce("__n", none),
        "items_sha256": F.coalesce("__sha", F.sha2(F.lit(""), 256)),
    })
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).drop("__doc", "__th", "__hit", "__n", "__sha")
