"""Release tables, search, digests and verification."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom import schemas
from cardloom.functions.text import canonical_array, fold_accents
from cardloom.sources import commits
from cardloom.sources.commits import shared_folder

SEARCHED = ("title", "summary", "products", "cves", "techniques")
LISTS = ("products", "cves", "techniques")
POSTING = "field string, token string, card_id string, pos int"


def card_table(cards: DataFrame) -> DataFrame:
    """One row a card, lists as JSON text, in id order over range partitions."""
    cols = [canonical_array(F.col(c)).alias(c) if c in LISTS else F.col(c) for c in schemas.names(schemas.CARD)]
    return cards.select(*cols).repartitionByRange("id").sortWithinPartitions("id")


def child_table(cards: DataFrame, column: str, value: str) -> DataFrame:
    """Rows card_id, position (from 0) and the value of a list column."""
    return cards.select(F.col("id").alias("card_id"), F.posexplode(column).alias("position", value))


def postings(cards: DataFrame) -> DataFrame:
    """Rows field, token, card_id, pos: words folded to lower case without accents.

    Null fields and texts without words give no rows. Rows are not gathered by
    token, so frequent words stay spread out.
    """
    text = lambda f: F.array_join(F.col(f), " ") if f in LISTS else F.col(f)
    fields = F.array(*[F.struct(F.lit(f).alias("field"), text(f).alias("text")) for f in SEARCHED])
    rows = cards.select(F.col("id").alias("card_id"), F.explode(fields).alias("f")).select("card_id", "f.field", F.lower(fold_accents(F.col("f.text"))).alias("text"))
    found = F.regexp_extract_all("text", F.lit(r"(?U)([\p{L}\p{N}\p{Co}]+)"), F.lit(1))
    return rows.select("field", "card_id", F.posexplode(found).alias("pos", "token")).select("field", "token", "card_id", "pos")


def posting_stats(post: DataFrame) -> DataFrame:
    """Number of cards for each field and token."""
    return post.groupBy("field", "token").agg(F.count_distinct("card_id").alias("df"))


#: Buckets of a field's tokens, and the parts over which the cards of a frequent token are dealt.
BUCKETS, SALTS = 64, 16


def token_bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def write_postings(post: DataFrame, path: str) -> None:
    """Writes postings by field and bucket of their token, each file sorted by token.

    A token with more than a bucket's mean share of all rows is dealt by card over SALTS
    parts, so that it fills no task of its own; there are at most BUCKETS such tokens.
    """
    spark = post.sparkSession
    counts = post.groupBy("field", "token").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = spark.createDataFrame([tuple(r) for r in counts.where(F.col("n") * BUCKETS > total).select("field", "token").collect()], "field string, token string").withColumn("often", F.lit(True))
    salt = F.when(F.col("often"), F.pmod(F.xxhash64("card_id"), F.lit(SALTS))).otherwise(0)
    rows = post.join(F.broadcast(frequent), ["field", "token"], "left").withColumns({"bucket": token_bucket(F.col("token")), "salt": salt})
    dealt = rows.repartition("field", "bucket", "salt").sortWithinPartitions("field", "bucket", "token", "card_id", "pos")
    dealt.select("field", "bucket", "token", "card_id", "pos").write.partitionBy("field", "bucket").parquet(path)


def search(post: DataFrame, field: str, terms: list[str]) -> DataFrame:
    """Ids, ascending, of the cards whose field holds every term (lower case, without accents); none for no terms.

    Postings that write_postings wrote are read in the terms' buckets only.
    """
    wanted = sorted(set(terms))
    rows = post.where((F.col("field") == field) & F.col("token").isin(wanted))
    if "bucket" in post.columns:
        rows = rows.where(F.col("bucket").isin(*[token_bucket(F.lit(t)) for t in wanted]))
    hits = rows.select(F.col("card_id").alias("id"), "token").distinct()
    return hits.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(wanted)).select("id").orderBy("id")


def search_release(spark: SparkSession, path: str, field: str, terms: list[str]) -> DataFrame:
    """search() in the last release below a path."""
    folder = read_manifest(spark, path).first()["folder"]
    return search(spark.read.schema(f"{POSTING}, bucket int").parquet(f"{folder}/postings"), field, terms)


def cards_for(cards: DataFrame, child: DataFrame, value: str, values: list[str]) -> DataFrame:
    """Cards that hold any of the values in a child table."""
    wanted = child.where(F.col(value).isin(values)).select(F.col("card_id").alias("id"))
    return cards.join(wanted, "id", "left_semi")


def cards_for_product(cards: DataFrame, child: DataFrame, values: list[str]) -> DataFrame:
    return cards_for(cards, child, "product", values)


def cards_for_cve(cards: DataFrame, child: DataFrame, values: list[str]) -> DataFrame:
    return cards_for(cards, child, "cve", values)


def cards_for_source(cards: DataFrame, name: str, url: str) -> DataFrame:
    return cards.where((F.col("source_name") == name) & (F.col("source_url") == url))


def row_digest(cols: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def table_digest(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row, digest: the same for any order and partitioning, and counting repeated rows.

    Rows' hashes are gathered by their first five hex digits, sorted and hashed,
    and those at most 2^20 hashes by their first two, and so on to one; no step
    gathers more than a share of the table.
    """
    rows = df.select(row_digest(cols or df.columns).alias("h"))
    for digits in (5, 2, 0):
        key = F.substring("h", 1, digits) if digits else F.lit("")
        hashes = F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256)
        rows = rows.groupBy(key.alias("k")).agg(hashes.alias("s")) if digits else rows.agg(hashes.alias("s"))
        rows = rows.select(F.concat(F.col("k"), F.col("s")).alias("h") if digits else F.col("s").alias("h"))
    return rows.select(F.col("h").alias("digest"))


def release_tables(cards: DataFrame) -> dict[str, DataFrame]:
    return {
        "cards": card_table(cards),
        "card_products": child_table(cards, "products", "product").repartitionByRange("product", "card_id").sortWithinPartitions("product", "card_id"),
        "card_cves": child_table(cards, "cves", "cve").repartitionByRange("cve", "card_id").sortWithinPartitions("cve", "card_id"),
        "postings": postings(cards),
    }


def metadata(spark: SparkSession, values: dict[str, str]) -> DataFrame:
    """Key and value rows of a release."""
    return spark.createDataFrame(sorted(values.items()), "key string, value string")


MANIFEST = "version long, compatibility string, schema_version string, generated_at string, card_count string, source_sha256 string, folder string, artifacts map<string,string>"


def issues_of(cards: DataFrame) -> DataFrame:
    """Issues of typed cards, as of the lines they are written as; each card is opened once."""
    from cardloom.operators import validate

    line = F.to_json(F.struct(*[c for c in cards.columns if c in schemas.names(schemas.ENRICHED)]))
    # numbers only tell lines apart
    raw = cards.select(F.monotonically_increasing_id().alias("line_no"), line.alias("line")).withColumn("v", F.try_parse_json("line"))
    own = validate.judged_lines(raw).select("line_no", F.explode_outer("issues").alias("i")).where("i is not null").select("line_no", "i.code", "i.location")
    twice = cards.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit(0).cast("long").alias("line_no"), F.lit("duplicate_id").alias("code"), F.concat(F.lit("$.id "), "id").alias("location"))
    return own.union(twice)


SUMS = ("h1", "h2", "h3", "h4")
DIGESTS = "name string, bucket string, n long, " + ", ".join(f"{h} decimal(38,0)" for h in SUMS)


def digest_tree(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows bucket, n, h1..h4: for each of 256 buckets of row digests how many there are and the sums of their quarters.

    Rows are summed where they are, so nothing is gathered or sorted; trees of
    parts of a table merge to that of all (merged_trees).
    """
    h = df.select(row_digest(cols or df.columns).alias("h"))
    # quarters of 15 hex digits: sums of less than 2^63 rows stay exact
    parts = [F.conv(F.substring("h", 1 + 16 * k, 15), 16, 10).cast("decimal(20,0)").alias(name) for k, name in enumerate(SUMS)]
    return merged_trees(h.select(F.substring("h", 1, 2).alias("bucket"), F.lit(1).alias("n"), *parts))


def merged_trees(trees: DataFrame) -> DataFrame:
    return trees.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.sum(h).cast("decimal(38,0)").alias(h) for h in SUMS])


def tree_root(tree: DataFrame) -> DataFrame:
    """One row, digest, of a digest tree: the same for any order, partitioning and split into parts."""
    line = F.concat_ws(":", "bucket", *[F.col(c).cast("string") for c in ("n", *SUMS)])
    return tree.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ","), 256).alias("digest"))


def tree_changes(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows bucket, expected, found (numbers of rows) of the buckets in which two trees differ."""
    cols = ("n", *SUMS)
    a = expected.select("bucket", F.struct(*cols).alias("a"))
    b = found.select("bucket", F.struct(*[F.col(c).cast(expected.schema[c].dataType).alias(c) for c in cols]).alias("b"))
    both = a.join(b, "bucket", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("bucket", F.coalesce("a.n", F.lit(0)).alias("expected"), F.coalesce("b.n", F.lit(0)).alias("found"))


def _release_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}")
    return df.select(*POSTING_COLUMNS) if name == "postings" else df


POSTING_COLUMNS = ("field", "token", "card_id", "pos")
ARTIFACTS = ("card_cves", "card_products", "cards", "postings")


def publish_release(cards: DataFrame, path: str, generated_at: str) -> DataFrame:
    """Writes the tables to a new folder below path, then a manifest; returns the manifest.

    Cards with any issue raise before a manifest is written, so the old release
    stays. Each manifest has a version of its own, which its publisher has claimed:
    of two that publish at once, one gets the next version and the other the one after. Readers take
    the last, so they see the old release until all tables of the new one are there. When the cards'
    digest is the last manifest's, no release is made. The cards are computed once; all tables
    come from their copy, and their digest trees are kept beside them.
    """
    from cardloom.operators.validate import gate

    spark = cards.sparkSession
    folder = f"{path}/release-{uuid.uuid4().hex}"
    # written once, here; no manifest names the folder until all is well
    cards.write.parquet(f"{folder}/source")
    cards = spark.read.parquet(f"{folder}/source")
    gate(issues_of(cards))
    cards = cards.select(*schemas.names(schemas.CARD))
    digest = tree_root(digest_tree(cards)).first()[0]
    last = read_manifest(spark, path)
    if last is not None and is_unchanged(digest, last):
        return last
    for name, df in release_tables(cards).items():
        if name == "postings":
            write_postings(df, f"{folder}/{name}")
        else:
            df.write.parquet(f"{folder}/{name}")
        tree = digest_tree(_release_table(spark, folder, name))
        tree.select(F.lit(name).alias("name"), *tree.columns).coalesce(1).write.mode("append").parquet(f"{folder}/digests")
    trees = spark.read.schema(DIGESTS).parquet(f"{folder}/digests")
    digests = {name: tree_root(trees.where(F.col("name") == name).drop("name")).first()[0] for name in ARTIFACTS}
    values = {"compatibility": schemas.COMPATIBILITY, "schema_version": str(schemas.SCHEMA_VERSION), "generated_at": generated_at, "card_count": str(spark.read.parquet(f"{folder}/cards").count()), "source_sha256": digest}
    metadata(spark, values).coalesce(1).write.parquet(f"{folder}/metadata")
    version = 1 if last is None else last.first()["version"] + 1
    while not commits.claim(spark, f"{path}/versions/{version}"):
        version += 1
    commits.put_text(spark, f"{path}/manifest/{version:012}.json", json.dumps({"version": version, **values, "folder": folder, "artifacts": digests}))
    return read_manifest(spark, path, version)


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The manifest with the highest version, or that of a version; None where there is none."""
    there = [n for n in commits.names(spark, f"{path}/manifest") if n.endswith(".json") and (version is None or int(n[:-5]) == version)]
    if not there:
        return None
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifest/{there[-1]}").collect()
    return spark.createDataFrame(rows, MANIFEST)


def verify_release(spark: SparkSession, path: str, names: tuple[str, ...] = ARTIFACTS) -> DataFrame:
    """Rows name, bucket, expected, found of what does not fit the manifest; none if the release is whole.

    A table's digests are compared bucket by bucket, so that a difference is
    located: expected and found are then numbers of rows of the bucket. A table or
    manifest that cannot be read is itself a difference, and so is a table of digests that the manifest does not
    know. names: the tables to read; the others are not opened.
    """
    m = read_manifest(spark, path)
    rows: list[tuple] = []
    out = spark.createDataFrame([], "name string, bucket string, expected string, found string")
    if m is None:
        return spark.createDataFrame([("manifest", None, "present", None)], out.schema)
    m = m.first()
    fixed = [("compatibility", schemas.COMPATIBILITY, m["compatibility"]), ("schema_version", str(schemas.SCHEMA_VERSION), m["schema_version"])]
    rows += [(name, None, want, got) for name, want, got in fixed if want != got]
    there = set(commits.names(spark, m["folder"]))
    if "digests" not in there:
        return spark.createDataFrame([*rows, ("digests", None, "present", None)], out.schema)
    trees = spark.read.schema(DIGESTS).parquet(f"{m['folder']}/digests")
    for name in names:
        tree = trees.where(F.col("name") == name).drop("name")
        root = tree_root(tree).first()[0]
        if root != m["artifacts"].get(name):
            rows.append((f"digests of {name}", None, m["artifacts"].get(name), root))
        if name not in there:
            rows.append((name, None, "present", None))
            continue
        changes = tree_changes(tree, digest_tree(_release_table(spark, m["folder"], name)))
        out = out.unionByName(changes.select(F.lit(name).alias("name"), "bucket", F.col("expected").cast("string").alias("expected"), F.col("found").cast("string").alias("found")))
    return out.unionByName(spark.createDataFrame(rows, out.schema)) if rows else out


def is_unchanged(digest: str, manifest: DataFrame) -> bool:
    return not manifest.where(F.col("source_sha256") == digest).isEmpty()
