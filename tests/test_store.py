"""The collecting store: buckets, filters, ledger and replays, in batch and as a stream."""

import pytest
from pyspark.sql import functions as F

from cardloom import schemas
from cardloom.operators.store import Store, collect_batch
from cardloom.sources import commits
from cardloom.streaming.streams import stream_collect
from tests.test_cards import RSS

URLS = [f"https://f{i}.example.org/" for i in range(4)]


def sources(spark):
    return spark.createDataFrame([(i, f"n{i}", u, 9) for i, u in enumerate(URLS)], schemas.SOURCES)


def feed(*keys):
    return ("<rss><channel>" + "".join(f"<item><guid>{k}</guid><title>t {k}</title></item>" for k in keys) + "</channel></rss>").encode()


def response(u, body, status=200, etag="e"):
    return (1, URLS[u], None, status, {"ETag": etag}, body, None, "2024-05-07T00:00:00Z")


BATCHES = [
    [response(0, feed("a", "b", "a")), response(1, feed("c")), response(2, b"<html/>"), response(3, None, 304)],
    [response(0, feed("a", "b", "d"), etag="f"), response(1, feed("c")), response(2, feed("x")), response(3, None, 500)],
    [response(0, None, 304), response(1, None, 404), response(2, None, 304), response(3, None, 304)],
]
CARDS = sorted(["t a", "t b", "t c", "t d", "t x"])


def batches(spark):
    return [spark.createDataFrame(b, schemas.RESPONSES) for b in BATCHES]


def contents(store):
    skip = ("batch", "bucket")
    rows = lambda df: sorted(str({k: v for k, v in r.asDict().items() if k not in skip}) for r in df.collect())
    return {name: rows(store.table(name)) for name in ("cards", "snapshots", "failures", "summary")} | {"state": rows(store.state())}


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("plain")), buckets=8, segments=1)
    for n, b in enumerate(batches(spark)):
        collect_batch(store, n, b, sources(spark))
    return store


def test_whole_runs(spark, plain):
    assert sorted(r["title"] for r in plain.table("cards").collect()) == CARDS
    by = {r["batch"]: r for r in plain.table("summary").collect()}
    assert [(r["cards_added"], r["cards_skipped"], r["snapshots_added"], r["sources_fetched"], r["sources_failed"]) for _, r in sorted(by.items())] == [(3, 1, 2, 2, 1), (2, 3, 2, 3, 1), (0, 0, 0, 0, 1)]
    assert {r["source_url"]: r["etag"] for r in plain.state().collect()} == {URLS[0]: "f", URLS[1]: "e", URLS[2]: "e"}
    assert sorted((r["batch"], r["reason"]) for r in plain.table("failures").collect()) == [(0, "unsupported_feed"), (1, "http_500"), (2, "http_404")]
    # neither cards nor state are written where there are none
    assert commits.names(spark, f"{plain.path}/cards") == ["batch=0", "batch=1"] == commits.names(spark, f"{plain.path}/state")
    before = contents(plain)
    collect_batch(plain, 1, batches(spark)[0], sources(spark))  # in the ledger already
    assert contents(plain) == before


@pytest.mark.parametrize("at", ["cards", "filters", "snapshots", "state", "failures", "summary", "ledger"])
def test_killed_batches_leave_nothing_and_are_replayed(spark, plain, tmp_path, monkeypatch, at):
    store = Store(spark, str(tmp_path), buckets=8, segments=1)
    collect_batch(store, 0, batches(spark)[0], sources(spark))
    before = contents(store)
    write, commit = Store.write, Store.commit

    def killed(self, name, batch, df):
        write(self, name, batch, df)
        if name == at:
            raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(Store, "write", killed)
        if at == "ledger":
            m.setattr(Store, "commit", lambda self, batch: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            collect_batch(store, 1, batches(spark)[1], sources(spark))
    assert contents(store) == before and Store.commit is commit
    for n in (1, 2):
        collect_batch(store, n, batches(spark)[n], sources(spark))
    assert contents(store) == contents(plain)


def test_stream_equals_batches_when_killed(spark, plain, tmp_path, monkeypatch):
    for n, b in enumerate(batches(spark)):
        b.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        args = (spark, str(tmp_path / "in"), sources(spark), str(tmp_path / "store"), str(tmp_path / "cp"))
        if n == 1:
            with monkeypatch.context() as m:
                m.setattr(Store, "commit", lambda self, batch: (_ for _ in ()).throw(RuntimeError("killed")))
                with pytest.raises(Exception, match="killed"):
                    stream_collect(*args).awaitTermination()
        stream_collect(*args).awaitTermination()
    assert contents(Store(spark, str(tmp_path / "store"))) == contents(plain)


def test_buckets_are_chosen_by_filters(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=64, segments=1)
    c = spark.range(2000).select(F.concat(F.lit("card-"), F.col("id").cast("string")).alias("id"), *[F.lit("x").alias(n) for n in schemas.names(schemas.CARD)[1:8]], *[F.array().cast("array<string>").alias(n) for n in ("products", "cves", "techniques")], F.lit("m").alias("confidence"), F.lit("p").alias("safety"))
    store.add_cards(0, c)
    store.commit(0)
    ids = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("card-"), F.col("id").cast("string")).alias("id"))
    known = store.known(ids(0, 3))
    plan = known._jdf.queryExecution().executedPlan().toString()
    wanted = {r["bucket"] for r in ids(0, 3).select(store.bucket(F.col("id")).alias("bucket")).collect()}
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    opened = {f.split("bucket=")[1].split("/")[0] for f in known.inputFiles()}
    read = {r["b"] for r in known.select(F.regexp_extract(F.input_file_name(), r"bucket=(\d+)", 1).alias("b")).distinct().collect()}
    assert len(read) <= 8 and {str(b) for b in wanted} <= read and opened
    assert store.known(ids(10_000, 10_003)).count() < 200  # new ids open next to nothing


def test_saturated_filters_change_no_result(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2, segments=1)
    card = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("card-"), F.col("id").cast("string")).alias("id"), *[F.lit("x").alias(n) for n in schemas.names(schemas.CARD)[1:8]], *[F.array().cast("array<string>").alias(n) for n in ("products", "cves", "techniques")], F.lit("m").alias("confidence"), F.lit("p").alias("safety"))
    for n, (lo, hi) in enumerate([(0, 60_000), (50_000, 70_000), (60_000, 71_000)]):
        batch = card(lo, hi)
        store.add_cards(n, batch.join(store.known(batch.select("id")), "id", "left_anti"))
        store.commit(n)
    false = store.may_hold(card(200_000, 201_000).select("id")).count()
    assert false > 100  # the filters are full
    ids = store.table("cards").select("id")
    assert ids.count() == ids.distinct().count() == 71_000


def test_compaction_keeps_all(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8, segments=1)
    for n, b in enumerate(batches(spark)[:2]):
        collect_batch(store, n, b, sources(spark))
    before = contents(store)
    store.compact()
    assert store.live() == [-1] and contents(store) == before
    collect_batch(store, 1, batches(spark)[0], sources(spark))  # a replay after compaction
    assert contents(store) == before
    collect_batch(store, 2, batches(spark)[2], sources(spark))
    store.compact()
    assert store.live() == [-2] and sorted(r["title"] for r in store.table("cards").collect()) == CARDS
    assert commits.names(spark, f"{store.path}/cards") == ["batch=-1", "batch=-2"]


def test_claims_are_given_once(spark, tmp_path):
    assert [commits.claim(spark, str(tmp_path / "c/x")) for _ in range(2)] == [True, False]
    commits.put_text(spark, str(tmp_path / "c/t.json"), "{}")
    assert commits.names(spark, str(tmp_path / "c")) == ["t.json", "x"] and commits.names(spark, str(tmp_path / "none")) == []
    assert RSS


def test_bodies_are_neither_broadcast_nor_shuffled(spark):
    from cardloom.operators.collect import classify_responses

    got = classify_responses(batches(spark)[0], sources(spark))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan or "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    physical = got._jdf.queryExecution().executedPlan().toString()
    bodies = [line for line in physical.splitlines() if "Exchange" in line and "content" in line]
    assert not bodies and got.count() == 4
