"""Repeated rows, null ids, nulls, long texts and empty tables, for every query and pipeline stage."""

import random

import pytest

import corpus_pipeline
from cardloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, h string, id string"
NAMES = "stone river light under cold wind paper glass green quiet hollow winter summer orange violet".split()


def prose(seed, n=40):
    rng = random.Random(seed)
    return " ".join(rng.choice(NAMES) + str(rng.randrange(90)) for _ in range(n))


def rows():
    """Twelve plain documents, one again as it is, one near copy, one toxic, one contaminated, and odd ones."""
    texts = [prose(i) for i in range(12)]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [(3, texts[3])]  # a repeated row
    out += [(20, texts[4] + " end"), (21, "you stupid worthless idiot, you pathetic moron! " + prose(21)), (22, prose(99, 30))]
    out += [(30, None), (31, ""), (32, " \n\t"), (33, "word " * 30_000), (None, prose(50)), (None, None)]
    return [(i, t, "en" if i is None or i % 2 else "de", "s", len(t or ""), "x", "y", "z") for i, t in out]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("edges")
    for name, own in (("full", rows()), ("none", [])):
        at = base / name
        spark.createDataFrame(own, DOCS).coalesce(2).write.parquet(str(at / "documents.parquet"))
        marks = [(r[0], int(r[0] != 21), int(r[0] == 21)) for r in own if r[0] is not None and r[1]]
        spark.createDataFrame(marks + ([(None, 1, 0), (2, None, None)] if own else []), "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
        spark.createDataFrame([(1, prose(99, 30)), (2, None), (None, "x y z")] if own else [], "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    return base


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_collocations"}))  # its rows are phrases, see test_tokens
def test_query_gives_a_row_for_each_row(spark, folders, name):
    got = QUERIES[name](spark, str(folders / "full")).collect()
    if name == "op5_pack_sequences":
        got = [r for r in got if r["piece"] == 0]
    if name == "op12_mixture_packing":
        got = [r for r in got if r["start"] == 0]
    want = sorted(str(r[0]) for r in rows())
    assert sorted(str(r["doc_id"]) for r in got) == want
    by = [r for r in got if r["doc_id"] == 3]
    same = [{k: v for k, v in r.asDict().items() if k not in ("sequence_id", "offset", "near_next", "near_edited", "edited_sha256", "edited_fingerprint") and not (name.startswith("op12") and k in ("length", "ids_crc32"))} for r in by]
    assert len(same) == 2 and same[0] == same[1]
    assert QUERIES[name](spark, str(folders / "none")).collect() == []


def kept(df):
    return sorted((str(r["doc_id"]), r["text"] or "") for r in df.collect())


def test_pipeline_stages(spark, folders):
    at = str(folders / "full")
    docs = spark.read.parquet(at + "/documents.parquet")
    everything = kept(docs)
    toxic, lines, near, clean, pack = (f for _, f in corpus_pipeline.STAGES)
    assert kept(toxic(spark, docs, at)) == [r for r in everything if r[0] != "21"]
    assert kept(lines(spark, docs, at)) == everything  # no line is in three documents
    left = kept(near(spark, docs, at))
    assert left == [r for r in everything if r[0] != "20"]
    assert kept(clean(spark, docs, at)) == [r for r in everything if r[0] != "22"]
    packed = pack(spark, docs, at).collect()
    assert len({(r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in packed}) == len(packed) and sum(r["piece"] == 0 for r in packed) == len(everything)
    for stage in (toxic, lines, near, clean):
        out = stage(spark, docs, at)
        assert out.columns == docs.columns
        none = stage(spark, spark.read.parquet(str(folders / "none/documents.parquet")), str(folders / "none"))
        assert none.columns == docs.columns and none.count() == 0


def test_pipeline_run(spark, folders):
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, str(folders / "full")).collect()}
    assert got == {r[0] for r in rows()} - {20, 21, 22}
    assert corpus_pipeline.run(spark, str(folders / "none")).count() == 0


def test_toxic_rows_without_id_go(spark, folders):
    docs = spark.createDataFrame([(None, "you stupid worthless idiot, you pathetic moron!"), (None, "a quiet river")], "doc_id long, text string")
    assert kept(corpus_pipeline.drop_toxic(spark, docs, str(folders / "full"))) == [("None", "a quiet river")]


def test_packed_bits_of_slices_and_chunks():
    import numpy as np
    import pyarrow as pa

    from cardloom.llm import fingerprint as fp

    values = [bytes([i]) * 128 for i in range(9)]
    want = np.frombuffer(b"".join(values), np.uint64).reshape(-1, 16).T
    one = pa.array(values, pa.binary())
    for got, of in ((one, want), (one.slice(2, 5), want[:, 2:7]), (pa.chunked_array([one.slice(1, 3), one.slice(0, 0), one.slice(4)]), want[:, 1:]), (one.slice(0, 0), want[:, :0])):
        assert (fp.packed(got) == of).all() and fp.packed(got).shape == of.shape
    # lengths that would only fit together are no fingerprints
    with pytest.raises(pa.ArrowInvalid):
        fp.packed(pa.array([b"x" * 120, b"x" * 136], pa.binary()))
