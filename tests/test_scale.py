"""What must hold for dictionaries, histories, digests, indexes and files of any size."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from cardloom.operators import health, rules


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- dictionaries


@pytest.mark.parametrize("limit", [1000, 3])
def test_phrases_of_any_length_match_as_their_regex(spark, limit):
    rng = random.Random(1)
    words = ["web", "cache", "cross-site", "X", "über", "sql", "c++", "(x)", "éa", "id_1"]
    phrases = {" ".join(rng.choice(words) for _ in range(k)) for k in range(1, 9) for _ in range(4)} | {"++", "a.b"}
    gaps = [" ", "  ", "\n", " ", "\t", "-", ".", ", ", "", " "]
    texts = ["".join(rng.choice(words) + (" " if rng.random() < 0.8 else rng.choice(gaps)) for _ in range(30)) for _ in range(80)]
    texts += ["(" + p + ")" for p in phrases] + ["x" + p for p in phrases] + [p.upper() + "." for p in phrases] + [" x ++ ", "a.b", "", None]
    slugs = {f"s{i}": (p,) for i, p in enumerate(sorted(phrases))} | {"any": tuple(sorted(phrases))}
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = t.select("id", F.explode(rules.match_slugs(F.col("text"), slugs)).alias("slug"))
    got = rules.match_dictionary(t, rules.dictionary_frame(spark, slugs), max_phrases=limit)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 300
    assert rules.match_dictionary(t, spark.createDataFrame([("s", " "), ("n", None)], "slug string, gram string"), limit).count() == 0


def test_phrases_of_a_long_text_are_split_once(spark, tmp_path):
    """Split again for each of its 10,000 places, the text would take minutes."""
    import time

    from cardloom.plans.queries import QUERIES

    spark.createDataFrame([(0, " ".join(f"w{i}" for i in range(40_000))), (8, "W4, w5 (w8)"), (16, ""), (24, None)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    began = time.perf_counter()
    got = sorted(tuple(r) for r in QUERIES["dictionary_of_phrases"](spark, str(tmp_path)).collect())
    took = time.perf_counter() - began
    assert got == [(0, 10_000, "w0", "w9996"), (8, 2, "w4", "w8")] and took < 60


# ---- streaks

OUTCOMES = "source_url string, source_name string, run_no long, run_at timestamp, failed boolean, failed_at string, reason string, ord int"


def history(n, seed, sources="abcdef", heartbeat=True):
    """Runs in which sources fail, succeed or have no row, and some fail twice."""
    rng = random.Random(seed)
    rows = []
    for k in range(1, n + 1):
        at = datetime.datetime(2024, 5, 1) + datetime.timedelta(hours=k)
        rows += [("hb", "hb", k, at, False, None, None, 0)] if heartbeat else []
        for u in sources:
            x = rng.random()
            rows += [(u, u, k, at, True, f"t{k}", f"r{k}", o) for o in range(2 if x < 0.1 else 1 if x < 0.75 else 0)]
            rows += [(u, u, k, at, False, None, None, 0)] if 0.75 <= x < 0.85 else []
    return rows


def brute_streaks(rows):
    last, out = max(r[2] for r in rows), []
    for u in {r[0] for r in rows}:
        bad = {}
        for r in sorted((r for r in rows if r[0] == u and r[4]), key=lambda r: (r[2], r[7])):
            bad[r[2]] = r
        k = last
        while k in bad:
            k -= 1
        if k < last:
            out.append((u, u, last - k, bad[k + 1][5], bad[last][6]))
    return sorted(out)


@pytest.mark.parametrize("fanout", [2, 3, 512])
def test_streaks_fold_by_ranges(spark, monkeypatch, fanout):
    monkeypatch.setattr(health, "FANOUT", fanout)
    for n in (1, 2, 9, 40):
        rows = history(n, n) + [("z", "z", k, datetime.datetime(2024, 5, 1), True, f"t{k}", f"r{k}", 0) for k in range(1, n + 1)]
        df = spark.createDataFrame(rows, OUTCOMES).repartition(3)
        got = health.health_streaks(df, df.select("run_no"))
        assert sorted(map(tuple, got.collect())) == brute_streaks(rows)


def test_a_long_history_is_no_straggler(spark):
    n = 300_000
    rows = spark.range(1, n + 1).select(F.lit("u").alias("source_url"), F.lit("n").alias("source_name"), F.col("id").alias("run_no"), (F.col("id") != 1000).alias("failed"), F.col("id").cast("string").alias("failed_at"), F.lit("r").alias("reason"), F.lit(0).alias("ord"))
    got = health.health_streaks(rows, rows.select("run_no"))
    assert [tuple(r) for r in got.collect()] == [("u", "n", n - 1000, "1001", "r")]
    windows = [line for line in plan(got).splitlines() if "Window" in line]
    assert not any("source_url" in line for line in windows)


def test_streamed_streaks_see_absence_and_survive_a_restart(spark, tmp_path):
    from cardloom.streaming.streams import ROCKSDB, health_after, stream_health

    rows = history(8, 5, "abcd")
    with pytest.raises(ValueError, match="RocksDB"):
        stream_health(spark.createDataFrame([], OUTCOMES))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        for lo, hi in ((1, 5), (6, 8)):
            spark.createDataFrame([r for r in rows if lo <= r[2] <= hi], OUTCOMES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            states = stream_health(spark.readStream.schema(OUTCOMES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
            out = states.writeStream.outputMode("update").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"))
            out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
            got = health_after(spark.read.parquet(str(tmp_path / "out")))
            assert sorted(map(tuple, got.collect())) == brute_streaks([r for r in rows if r[2] <= hi])
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


# ---- validation in one pass


def brute_strings(value, at="$"):
    if isinstance(value, str):
        yield at, value
    elif isinstance(value, list):
        for i, x in enumerate(value):
            yield from brute_strings(x, f"{at}[{i}]")
    elif isinstance(value, dict):
        for k in sorted(value):
            yield from brute_strings(value[k], f"{at}.{k}")


def test_strings_at_any_depth_natively(spark):
    import json

    from cardloom.operators import validate

    rng = random.Random(2)

    def value(depth):
        kind = rng.randrange(6) if depth else rng.randrange(4)
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        if kind == 5:
            return {rng.choice(["a", "b c", "é", 'q"', "[x]", "title", "z.y"]): value(depth - 1) for _ in range(rng.randrange(4))}
        return [None, 1.5, True, rng.choice(["", "text", "}{][", '\\" {', "a\nb", "😀"])][kind]

    known = {"id": "i", "title": "t", "products": ["p"], "enrichment": {"version": 1, "cves": ["c"]}}
    values = [{"x": value(5), "title": value(2)} for _ in range(80)] + [known, known | {"deep": [[[[[[["s"]]]]]]]}, known | {"title": ["in", {"a": "list"}]}, known | {"enrichment": {"odd": {"a": ["b"]}}}, known | {"products": [["p"]]}, known | {"enrichment": ["e"]}, {}]
    lines = [json.dumps(v) for v in values] + ["[1]", "no json", ""]
    raw = spark.createDataFrame(list(enumerate(lines)), "line_no long, line string").withColumn("v", F.try_parse_json("line"))
    got = validate.walk_text(raw)
    assert "Python" not in plan(got) and "Arrow" not in plan(got)
    found = {}
    for r in got.orderBy("line_no", "item_ord").collect():
        found.setdefault(r["line_no"], []).append((r["location"], r["text"]))
    for i, v in enumerate(values):
        assert sorted(found.get(i, [])) == sorted(brute_strings(v)), v
        if "x" in v:
            assert found.get(i, []) == list(brute_strings(v))
    assert not {n for n in found if n >= len(values)}


def test_validation_reads_lines_once(spark, tmp_path):
    import json

    from cardloom.operators import validate
    from cardloom.sources import readers
    from tests.test_cards import card

    good = [card(id=f"card-{i:012x}") for i in range(3000)]
    lines = [json.dumps(c) for c in good]
    lines[5] = json.dumps(good[5] | {"title": ""})
    lines[700] = json.dumps(good[1])
    lines[1500] = json.dumps(good[2] | {"summary": "other"})
    lines[2000] = json.dumps(good[2000] | {"note": {"deep": ["password = synthetic-value-0001"]}})
    lines[2500], lines[2600], lines[2700] = "", "[1]", "{"
    at = tmp_path / "cards"
    at.mkdir()
    (at / "a.jsonl").write_text("\n".join(lines) + "\n")
    (at / "b.jsonl").write_text("\n".join(["{", json.dumps(good[7] | {"id": "card-ffffffffffff"})]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        raw = readers.read_cards_raw(spark, str(at))
        for df in (raw, validate.judged_lines(raw)):
            assert plan(df).count("FileScan text") == 2 and "BroadcastHashJoin" in plan(df) and "SortMergeJoin" not in plan(df) and "Python" not in plan(df)
        both = raw.where("file like '%a.jsonl'").cache()
        assert both.rdd.getNumPartitions() > 5
        numbers = {r["line_no"]: r["line"] for r in both.collect()}
        assert [numbers[i + 1] for i in range(len(lines))] == lines
        issues, report = validate.validate_file(both)
        got = [(r["line_no"], r["code"], r["location"]) for r in issues.collect()]
        assert got == [
            (6, "string_empty", "line 6.title"), (701, "duplicate_id", "line 701.id"), (1501, "duplicate_id", "line 1501.id"), (1501, "conflicting_id_content", "line 1501.id"),
            (2001, "secret.assignment", "line 2001.note.deep[0]"), (2501, "malformed_jsonl", "line 2501"), (2601, "card_type", "line 2601"), (2701, "malformed_jsonl", "line 2701"),
        ]
        assert tuple(report.first()) == (len(lines) - 3, len(got), False, 1)
        clean = raw.where("file like '%b.jsonl' and line_no = 2")
        issues, report = validate.validate_file(clean)
        assert issues.count() == 0 and tuple(report.first()) == (1, 0, True, 0)
        issues, report = validate.validate_file(clean.limit(0))
        assert issues.count() == 0 and tuple(report.first()) == (0, 0, True, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# ---- releases


def cards_frame(spark, n=60):
    from tests.test_cards import card, typed

    return typed(spark, *[card(id=f"card-{i:012x}", title=f"Common number {i}" + (" Café rare" if i % 7 == 0 else ""), products=["php"] if i % 3 == 0 else []) for i in range(n)])


def test_parallel_publishers_get_versions_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from cardloom.operators import release
    from cardloom.sources import commits

    path = str(tmp_path / "rel")
    release.publish_release(cards_frame(spark, 2), path, "now")
    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(lambda n: release.publish_release(cards_frame(spark, n), path, "later").first(), (3, 4)))
    assert sorted(m["version"] for m in got) == [2, 3] and {m["card_count"] for m in got} == {"3", "4"}
    assert release.read_manifest(spark, path).first()["version"] == 3 and release.verify_release(spark, path).isEmpty()
    # a publisher that died after its claim leaves a gap
    assert commits.claim(spark, f"{path}/versions/4")
    assert release.publish_release(cards_frame(spark, 5), path, "later").first()["version"] == 5


def test_verify_names_the_bucket_that_differs(spark, tmp_path):
    from cardloom.operators import release
    from cardloom.sources import commits

    path = str(tmp_path / "rel")
    assert [tuple(r) for r in release.verify_release(spark, path).collect()] == [("manifest", None, "present", None)]
    folder = release.publish_release(cards_frame(spark), path, "now").first()["folder"]
    own = spark.read.parquet(f"{folder}/cards")
    changed = own.withColumn("title", F.when(F.col("id").endswith("00a"), "other").otherwise(F.col("title")))
    digest = lambda df: df.where("id like '%00a'").select(F.substring(release.row_digest(df.columns), 1, 2)).first()[0]
    want = {digest(own), digest(changed)}
    changed.write.parquet(f"{tmp_path}/changed")
    commits.drop(spark, f"{folder}/cards")
    spark.read.parquet(f"{tmp_path}/changed").write.parquet(f"{folder}/cards")
    bad = release.verify_release(spark, path).collect()
    assert {r["name"] for r in bad} == {"cards"} and {r["bucket"] for r in bad} == want
    # tables that are not asked for are not opened
    commits.drop(spark, f"{folder}/card_cves")
    assert release.verify_release(spark, path, ("postings", "card_products")).isEmpty()
    assert ("card_cves", None, "present", None) in [tuple(r) for r in release.verify_release(spark, path).collect()]
    commits.drop(spark, f"{folder}/digests")
    assert [r["name"] for r in release.verify_release(spark, path).collect()] == ["digests"]


def test_digest_trees_merge_and_ignore_order(spark):
    from cardloom.operators import release

    df = spark.range(500).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("a"), F.lit(None).cast("string").alias("b"))
    root = lambda t: release.tree_root(t).first()[0]
    whole = root(release.digest_tree(df))
    assert whole == root(release.digest_tree(df.repartition(7).orderBy(F.rand(1))))
    parts = release.digest_tree(df.limit(100)).union(release.digest_tree(df.exceptAll(df.limit(100))))
    assert whole == root(release.merged_trees(parts)) != root(release.digest_tree(df.union(df.limit(1))))


def test_search_opens_its_buckets_only(spark, tmp_path):
    from cardloom.operators import release

    path = str(tmp_path / "rel")
    folder = release.publish_release(cards_frame(spark), path, "now").first()["folder"]
    for terms, want in ((["common", "cafe", "rare"], 9), (["common"], 60), (["common", "absent"], 0), ([], 0)):
        got = release.search_release(spark, path, "title", terms)
        assert got.count() == want and [r[0] for r in got.collect()] == sorted(r[0] for r in got.collect())
    got = release.search_release(spark, path, "title", ["common", "rare"])
    filters = plan(got).split("PartitionFilters: [")[1].split("]")[0]
    assert "field" in filters and "bucket" in filters
    post = spark.read.parquet(f"{folder}/postings")
    assert post.where("token = 'common'").select(F.input_file_name()).distinct().count() >= 1
    assert post.count() == release.postings(cards_frame(spark)).count()


# ---- addresses


def test_addresses_natively(spark):
    import ipaddress

    from cardloom.functions import addresses

    texts = ["", "1.2.3", "01.2.3.4", "1.2.3.4.5", "1:2:3:4:5:6:7::", "::1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8::", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.4", "fe80::1%eth0", "::%", ":::", "1::2::3", ":1::", "g::"]
    for block in addresses.SPECIAL_4 + addresses.SPECIAL_6:
        net = ipaddress.ip_network(block)
        kind, top = type(net[0]), 2 ** (32 if net.version == 4 else 128)
        for x in (int(net[0]) - 1, int(net[0]), int(net[-1]), int(net[-1]) + 1):
            if 0 <= x < top:
                texts += [str(kind(x)), kind(x).exploded] + ([f"::ffff:{kind(x)}", f"64:ff9b::{kind(x)}"] if net.version == 4 else [])
    rng = random.Random(3)
    texts += ["".join(rng.choice(["0", "1", "ffff", "2001", "db8", "::", ":", ":", ".", "1.2.3.4", "255", "01", "abcde"]) for _ in range(rng.randrange(1, 16))) for _ in range(3000)]

    def want(t):
        try:
            ip = ipaddress.ip_address(t)
        except ValueError:
            return None
        return ip.is_global and not ip.is_multicast

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", addresses.is_global(F.col("t")).alias("g"))
    assert "Python" not in plan(got)
    assert [(r["t"], r["g"]) for r in got.collect()] == [(t, want(t)) for t in texts]


def test_urls_are_cleaned_before_they_are_split(spark):
    from cardloom.functions import urls

    rows = [(" \x01https://a.example.org/x", True), ("htt\tps://a.exa\nmple.org/", True), ("https://a.example.org/\r", True), ("\t ", False), (" http://localhost/", False), ("http://10.0.\t0.1/", False)]
    got = spark.createDataFrame(rows, "u string, want boolean").select("want", urls.is_public_url(F.col("u")).alias("got"), urls.safe_article_url(F.col("u"), F.lit("f")).alias("a"), "u")
    for r in got.collect():
        assert r["got"] == r["want"] and r["a"] == (r["u"] if r["want"] else "f")
