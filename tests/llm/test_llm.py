"""The training-data operators against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cardloom.llm import decontam, fingerprint, langid, linededup, neardup, packing, pii, quality, secret_scan, toxicity
from cardloom.llm.queries import TOKENIZER

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and stone river light under cold wind paper glass green quiet hollow winter summer orange violet".split()


def frame(spark, texts, extra=False):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    # columns with names that the operators use themselves
    return df.withColumns({"h": F.lit(1), "id": F.lit(2), "component": F.lit("x"), "score": F.lit(0)}) if extra else df


def odd_texts():
    return [None, "", " \n\t", "a", "word " * 5000, "same text here", "same text here", "Z" * 30000, "ünï 日本語 😀", "\n\n\n"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(500)) for _ in range(n))


# ---- lines


def brute_lines(texts):
    strip = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in line.strip(strip))
    cut = [(t or "").split("\n") for t in texts]
    holds = {}
    for i, own in enumerate(cut):
        for k in {key(x) for x in own}:
            holds.setdefault(k, []).append(i)
    gone = lambda i, x: len(key(x)) >= 20 and len(holds[key(x)]) >= 3 and i < max(holds[key(x)])
    return ["\n".join(x for x in own if not gone(i, x)) for i, own in enumerate(cut)]


@pytest.mark.parametrize("batches", [1, 3])
def test_line_dedup(spark, batches):
    rng = random.Random(1)
    pool = [sentence(rng, 4) for _ in range(12)] + ["  " + "Shared Line Of Some Length ", "shared line of some length", "", "short"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 8))) for _ in range(60)] + odd_texts()
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(frame(spark, texts, True), batches=batches, buckets=2).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts)


def test_line_runs_compact_and_anti_join(spark, monkeypatch):
    runs = linededup.LineRuns(spark, buckets=2)
    line = "a line that is long enough"
    for i in reversed(range(5)):
        docs = frame(spark, [line, f"another line, number {i} of five"]).withColumn("doc_id", F.col("doc_id") + 10 * i)
        runs.add(linededup.long_lines(docs))
    assert [len(level) for level in runs.levels] == [1, 0, 1] and runs.compactions == 3
    # settled after three batches, the line is in no later run
    assert {(r["max_doc"], r["n_docs"]) for r in runs.seen().where("n_docs > 1").collect()} in ({(40, 3)}, {(40, 4)})
    assert {r["max_doc"] for r in runs.frequent().collect()} == {40}
    counts = linededup.line_counts(linededup.long_lines(frame(spark, [line + "\n" + "this line is new to all the runs"])))
    assert runs.unsettled(counts).count() == 1
    runs.close()
    assert linededup.dedup_lines(frame(spark, [])).count() == 0
    calls = []
    plain = linededup.LineRuns.unsettled
    monkeypatch.setattr(linededup.LineRuns, "unsettled", lambda self, c: calls.append(1) or plain(self, c))
    linededup.dedup_lines(frame(spark, [f"{line}\n{i}" for i in range(40)]), buckets=2).count()
    assert len(calls) == 4  # dedup_lines goes through the anti-join in each batch


def test_line_runs_are_not_shuffled(spark):
    runs = linededup.LineRuns(spark, buckets=4, fanout=9)  # as many as the session's shuffle partitions
    for i in reversed(range(3)):
        runs.add(linededup.long_lines(frame(spark, [sentence(random.Random(i), 4)]).withColumn("doc_id", F.lit(i).cast("long"))))
    counts = linededup.line_counts(linededup.long_lines(frame(spark, [sentence(random.Random(9), 4)])))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    exchanges = lambda df: plan(df).count("Exchange hashpartitioning")
    joined = runs.unsettled(counts)
    # the three anti-joins add no exchange to those of the batch's own counts
    assert plan(joined).count("SortMergeJoin") == 3 and "BroadcastHashJoin" not in plan(joined)
    assert exchanges(joined) == exchanges(counts) == 2
    merge = runs.merged(*runs.levels[0][:2])
    assert "SortMergeJoin" in plan(merge) and exchanges(merge) == 0
    runs.close()


# ---- benchmark


def brute_hits(text, items):
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    w = cut(text)
    hit, ids = set(), set()
    for i, t in items:
        b = cut(t)
        n = min(13, len(b))
        for s in range(max(0, len(b) - 13) + 1 if b else 0):
            for at in range(len(w) - n + 1):
                if w[at : at + n] == b[s : s + n]:
                    hit |= set(range(at, at + n))
                    ids.add(i)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, sentence(rng, rng.choice([13, 14, 20, 40]))) for i in range(6)] + [(20, "one"), (21, "Two words"), (22, ""), (23, None), (24, "the the the " * 6), (25, sentence(rng, 5))]
    long = [t for i, t in items if i < 6]
    texts = odd_texts()
    for _ in range(40):
        t = rng.choice(long).split()
        s = rng.randrange(len(t))
        texts.append(" ".join([sentence(rng, rng.randrange(0, 30)), *t[s : s + rng.randrange(5, 30)], sentence(rng, rng.randrange(0, 300)), rng.choice(["ONE", "two, words", "the " * 20, ""])]))
    got = decontam.contamination(frame(spark, texts, True), spark.createDataFrame(items, "item_id long, text string"))
    by = {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in got.collect()}
    for i, t in enumerate(texts):
        assert by[i] == brute_hits(t, items), i
    # the same by shuffle joins, where nothing is few enough to send
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    again = decontam.contamination(frame(spark, texts, True), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in again.collect()} == by
    none = decontam.contamination(frame(spark, texts[:3]), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated").count() == 0 and none.count() == 3


def test_decontamination_joins_prefixes_alone(spark, monkeypatch):
    """Many items share a passage: a document has one place a window, however many items own it."""
    rng = random.Random(7)
    shared = sentence(rng, 15)
    items = [(i, shared if i % 2 else f"{shared} {sentence(rng, 3)}") for i in range(40)]
    texts = [f"{sentence(rng, 5)} {shared} {sentence(rng, 5)}", sentence(rng, 30), *[" ".join(shared.split()[:12]) for _ in range(5)]]
    seen = []
    plain = decontam.cut_lineage
    monkeypatch.setattr(decontam, "cut_lineage", lambda df: seen.append(plain(df)) or seen[-1])
    got = decontam.contamination(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    by = {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in got.collect()}
    assert [by[i] for i in range(len(texts))] == [brute_hits(t, items) for t in texts]
    places = [df for df in seen if "at" in df.columns]
    assert len(places) == 1 and places[0].where("doc_id = 0").count() == 3


# ---- near-duplicates


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    head = list(range(len(texts)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                head[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_near_duplicates(spark):
    rng = random.Random(3)
    texts = odd_texts()
    for size in (80, 150):
        base = sentence(rng, size).split()
        for _ in range(30):  # copies of one text whose copies are often not alike themselves
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = "edit" + str(rng.randrange(10**6))
            texts.append(" ".join(w))
    texts += [sentence(rng, 50) for _ in range(20)]
    got = {r["doc_id"]: r for r in neardup.near_duplicates(frame(spark, texts, True)).collect()}
    want = brute_components(texts)
    for i in range(len(texts)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == want[i], i
        assert got[i]["kept"] == (want[i][1] == i)
    assert neardup.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {(r["id"], r["component"]) for r in neardup.components(links).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


# ---- packing


def test_packing(spark):
    import numpy as np
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = odd_texts() + [sentence(rng, rng.randrange(1, 900)) for _ in range(60)]
    rows = packing.pack(frame(spark, texts, True), TOKENIZER, capacity=512, shard_pieces=30).collect()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path(TOKENIZER))
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r["piece"]):
            part = ids[at : at + 512]
            assert (r["start"], r["length"], r["ids_crc32"]) == (at, len(part), zlib.crc32(part.tobytes()))
            at += 512
        assert at >= len(ids)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    least = -(-sum(r["length"] for r in rows) // 512)
    assert len(bins) <= 1.1 * least + 1


def test_tokenizer_parts_equal_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path(TOKENIZER))
    texts = ["naïve café's don't I'LL", "J̌ x", "a\x1cb", "İstanbul ΣΑΣ", "<|endoftext|> hi", "x²½ ³", "_a_b", "ñ!!'s it's|", "日本語 テスト　x", "ǅ ǆ Ÿ ß ẞ", "a\u0085b", "ƻǀ ʔ"]
    for t, ids in zip(texts, packing.tokenizer_ids(packing.tokenizer_path(TOKENIZER))(texts), strict=True):
        assert ids == b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(t, add_special_tokens=False).ids)


# ---- fingerprints


def test_fingerprints(spark):
    rng = random.Random(5)
    texts = [sentence(rng, rng.randrange(20, 200)) for _ in range(120)]
    texts += [texts[0], None, "", "x", "abc " * 20000]
    rows = {r["doc_id"]: r for r in fingerprint.fingerprints(frame(spark, texts, True)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        t, n = t or "", texts[(i + 1) % len(texts)] or ""
        k = len(t) // 2
        assert rows[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - k] + n[:k]).encode()).hexdigest()
        assert rows[i]["n_chars"] == len(t)
    assert rows[0]["fingerprint"] == rows[120]["fingerprint"]
    assert sum(rows[i]["near_edited"] > rows[i]["near_next"] + 0.1 for i in range(120)) >= 118
    changed = [t.replace(t.split()[3], "other", 1) for t in texts[:50]]
    both = fingerprint.fingerprints(frame(spark, texts[:50] + changed)).select("doc_id", "fingerprint")
    pairs = {(r["a"], r["b"]) for r in fingerprint.near_pairs(both).collect()}
    assert sum((i, i + 50) in pairs for i in range(50)) >= 45 and all(b == a + 50 for a, b in pairs)
    assert fingerprint.fingerprints(frame(spark, [])).count() == 0


def test_fingerprint_classes(spark, tmp_path):
    from cardloom.llm.queries import QUERIES

    rng = random.Random(9)
    texts = [sentence(rng, 80) for _ in range(30)]
    for t in texts[:30]:  # copies, some of them alike enough
        w = t.split()
        for k in rng.sample(range(80), 4):
            w[k] = "edit" + str(rng.randrange(10**6))
        texts.append(" ".join(w))
    texts += [texts[0], None, ""]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in QUERIES["op2_fingerprints"](spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    bits = fingerprint.signed([t or "" for t in texts])
    head = list(range(len(texts)))
    for i in range(len(texts)):  # brute force
        for j in range(i):
            if fingerprint.likeness(bits[i : i + 1], bits[j : j + 1])[0] >= 0.75:
                x, y = head[i], head[j]
                head = [min(x, y) if h in (x, y) else h for h in head]
    linked = [i for i in range(len(texts)) if head.count(head[i]) > 1]
    assert len(linked) >= 20
    assert sum(rows[i]["class_id"] == head[i] for i in range(len(texts))) >= len(texts) - 0.1 * len(linked)
    assert rows[62]["class_id"] == 61 and rows[60]["class_id"] == 0


def test_leftover_members_are_linked(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    b = 2 * rng.integers(0, 2, 512) - 1
    far, close = b.copy(), b.copy()
    far[rng.choice(512, 150, False)] *= -1  # not alike to b, but in buckets with it
    close[:] = far
    close[rng.choice(512, 60, False)] *= -1
    prints = spark.createDataFrame(list(enumerate(fingerprint.hexed(np.array([b, far, close], np.int8)))), "doc_id long, fingerprint string")
    # one band of no digits puts all in one bucket, whose centre is 0
    for block in (1, 1024):
        got = {(r["a"], r["b"]) for r in fingerprint.near_pairs(prints, bands=1, digits=0, block=block).collect()}
        assert got == {(1, 2)}


def test_links_whose_sketches_differ_in_the_first_bit(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    b = 2 * rng.integers(0, 2, 512) - 1
    far = b.copy()
    far[rng.choice(512, 150, False)] *= -1  # not alike to b, but in buckets with it
    close = far.copy()
    close[[0, 243]] *= -1  # first and last bit of a sketched word
    prints = spark.createDataFrame(list(enumerate(fingerprint.hexed(np.array([b, far, close], np.int8)))), "doc_id long, fingerprint string")
    for block in (1, 1024):
        assert {(r["a"], r["b"]) for r in fingerprint.near_pairs(prints, bands=1, digits=0, block=block).collect()} == {(1, 2)}


def test_packed_likeness():
    import numpy as np

    rng = np.random.default_rng(2)
    bits = rng.integers(-1, 2, (40, 512)).astype(np.int8)
    bits[20:30] = 2 * (bits[20:30] > 0) - 1
    bits[30:] = bits[:10]
    bits[30:, :50] = 0
    bits[[5, 6]] = 0
    column = [np.packbits(r > 0).tobytes() + np.packbits(r != 0).tobytes() for r in bits]
    import pyarrow as pa

    words = fingerprint.packed(pa.array(column))
    i, k = (x.ravel() for x in np.indices((40, 40)))
    assert np.array_equal(fingerprint.packed_likeness(words, words, i, k, 100), fingerprint.likeness(bits[i], bits[k]))


def test_fingerprints_leave_no_texts_on_disk(spark):
    import time

    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        found = [files.apply(i) for i in range(files.size())]
        return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}

    rng = random.Random(3)
    texts = ["".join(chr(rng.randrange(33, 0x3000)) for _ in range(3000)) for _ in range(300)]
    before = left()
    out = fingerprint.classes(fingerprint.fingerprints(frame(spark, texts)))
    until = time.time() + 10
    while (size := sum(n for f, n in left().items() if f not in before)) > 300_000 and time.time() < until:
        time.sleep(0.2)
    assert size <= 300_000 < sum(map(len, texts))
    assert out.count() == 300


# ---- personal data


def brute_spans(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_patterns():
    rng = random.Random(6)
    for _ in range(3000):
        t = "".join(rng.choice("ab1.@+-(0 9%4") for _ in range(rng.randrange(0, 40)))
        assert pii.base_spans(t) == brute_spans(t), t


def test_personal_data(spark):
    texts = odd_texts() + ["write ann dot lee at mail dot example dot com today", "call (020) 7946 0958 now", "b@mail.example.com +1 (017) 555-7713", "version 2.0 of 2024-05-06", "1" * 50000]
    rows = {r["doc_id"]: r for r in pii.find(frame(spark, texts, True)).collect()}
    n = len(odd_texts())
    assert rows[n]["spans"] == "email:6:45" and rows[n]["n_email"] == 0
    assert rows[n + 1]["spans"] == "phone:5:20"
    assert rows[n + 2]["spans"] == "email:0:18,phone:19:36" and rows[n + 2]["n_phone"] == 1
    assert rows[n + 3]["spans"] == "" and rows[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(texts)


def test_long_windows_lose_no_span(spark):
    call = "call (020) 7946 0958 now "
    texts = ["x " * k + call * 300 for k in range(3)]
    for r, k in zip(pii.find(frame(spark, texts)).orderBy("doc_id").collect(), range(3), strict=True):
        assert r["spans"] == ",".join(f"phone:{2 * k + 25 * i + 5}:{2 * k + 25 * i + 20}" for i in range(300))


#: Labelled lines that the field has not learned from.
HELD_OUT = """
a note to {email:finn dot oak at desk dot example dot com} helps
for press {email:media [at] firm [dot] example [dot] org} only
mail {email:lou.bee (at) example.net} at any time
then {email:sam at example dot com} replied
and {email:kit_4 @ host . example . net} bounced
it came from {email:team at club dot example dot com} , i think
forms go to {email:desk (at) town (dot) example (dot) org} by friday
copy {email:vic.n [at] web.example.com} too
she is {email:jo dot may at home dot example dot net} now
ring me at {phone:(040) 5550 2218} later
phone : {phone:718-555-0147} .
my mobile , {phone:0172 5550 9911} , is off
tel {phone:(503) 555-0126} or mail
fax {phone:0161 496 0330} works too
call {phone:312.555.0199} at once
from abroad dial {phone:00 44 161 496 0442} please
gateway {ip:192 . 0 . 2 . 17} is slow
blocked {ip:198[.]51[.]100[.]77} last night
the box at {ip:203 dot 0 dot 113 dot 21} hums
we saw {ip:10 [.] 8 [.] 0 [.] 14} again
card {card:3530.1113.3330.0000} expired
with {card:6011/1111/1111/1117} on file
card {card:5555_5555_5555_4444} was declined
they sat at the table by the dot matrix printer
come at 7 , eat at 8 , sleep at 11
from 2015 to 2018 it grew by 3.5 or 4.5 percent
release 4.2.11.3 fixes page 12 of the guide
he drew a dot at the corner and a line at the top
invoice 88213456 of 2021-03-04 at 09:20
psalm 119 , verses 1 - 8 and 9 - 16
columns 5 6 7 8 were empty in table 31
hash 77fe01ab93cd5512 of 2048 bytes
it cost 2,500,000.00 in 1987
a dot com firm at the edge of town
""".strip().splitlines()


def test_field_on_held_out_lines(spark):
    want, texts = [], []
    for line in HELD_OUT:
        plain, at = "", 0
        for m in re.finditer(r"\{(\w+):([^}]*)\}", line):
            plain += line[at : m.start()]
            want.append((len(texts), f"{m[1]}:{len(plain)}:{len(plain) + len(m[2])}"))
            plain, at = plain + m[2], m.end()
        texts.append(plain + line[at:])
    assert not {line.replace("{", "").replace("}", "") for line in pii.LABELLED} & set(texts)
    rows = pii.find(frame(spark, texts)).collect()
    base = {(i, s) for i, t in enumerate(texts) for s in pii.joined(pii.base_spans(t)).split(",")}  # a release number, and no span wanted
    got = {(r["doc_id"], s) for r in rows for s in r["spans"].split(",") if s} - base
    assert not base & set(want)
    right = len(got & set(want))
    assert right >= 0.9 * len(want) and right >= 0.9 * len(got)


# ---- models


def labelled(spark, n=200):
    """Good prose and shouted text; every fourth holds an insult."""
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        bad, toxic = i % 3 == 0, i % 4 == 0
        t = sentence(rng, 60).upper().replace(" ", "!! ") if bad else sentence(rng, 60)
        if toxic:
            t += " you " + rng.choice(["zorgish", "blemful"]) + " idiot " + sentence(rng, 5)
        docs.append((i, t, "en", "s", len(t)))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_and_toxicity_on_held_out_documents(spark):
    docs, labels = labelled(spark)
    for score, label in ((quality.score_documents, "quality"), (toxicity.score_documents, "toxic")):
        rows = score(docs, labels).join(labels, "doc_id").where("held_out").collect()
        assert rows and all(0 <= r["score"] <= 1 for r in rows)
        assert sum(r["predicted"] == r[label] for r in rows) >= 0.9 * len(rows), label
        odd = score(frame(spark, odd_texts(), True), labels).collect()
        assert len(odd) == len(odd_texts())
        assert score(frame(spark, []), labels.limit(0)).count() == 0


def test_toxic_grammar_forms():
    g = toxicity.Grammar([])
    form = lambda t: [i for i, x in enumerate(g.forms(t)) if x]
    assert form("you are an idiot") == [1] and form("an idiot") == [0]
    assert form("he is not an idiot") == [2] and form("she said idiot") == [3]
    assert form("I will kill you") == [4] and form("kill the process") == [] and form("idiotic") == []


def test_toxic_grammar_reads_whole_clauses():
    g = toxicity.Grammar([])
    form = lambda t: [i for i, x in enumerate(g.forms(t)) if x]
    far = "of the old stone house by the cold green river " * 20
    assert form("I will kill every last one of you") == [4] and form(f"I will {far} kill {far} you") == [4]
    assert form(f"she said {far} idiot") == [3] and form(f"not {far} idiot") == [2] and form(f"an idiot {far} you") == [1]
    assert form("I will. kill you") == [] and form("not so. you idiot! she said") == [1] and form("an idiot: you") == [0]


def test_language(spark):
    rng = random.Random(8)
    alphabets = {"aa": "abcdef", "bb": "ghijkl", "cc": "mnopqr"}
    rows = []
    for i in range(150):
        lang = rng.choice(list(alphabets))
        t = " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(20))
        rows.append((i, t, lang, "s", len(t)))
    docs = spark.createDataFrame(rows, DOCS)
    got = langid.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got) and got
    model = langid.fit(docs)
    odd = langid.identify(frame(spark, odd_texts(), True), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in odd[:3]] == ["und"] * 3 and len(odd) == len(odd_texts())
    code = langid.codewords(9)
    assert min((code[i] != code[j]).sum() for i in range(9) for j in range(i)) > 15


def test_secrets(spark):
    texts = [*odd_texts(), 'x token = "3dc91a32781def2fd668aa2fd071eacee1a19444" y', "commit 3dc91a32781def2fd668aa2fd071eacee1a19444 fixed", "see /usr/share/page-12/index.html now", "password=7187d069216479d4e3"]
    rows = {r["doc_id"]: r for r in secret_scan.scan_documents(frame(spark, texts, True)).collect()}
    n = len(odd_texts())
    assert len(rows) == len(texts)
    assert [rows[n + k]["n_secrets"] for k in range(4)] == [1, 0, 0, 1]
    assert secret_scan.scan_documents(frame(spark, [])).count() == 0


def test_every_value_of_a_word_is_a_candidate(spark):
    token, long = "ghp_9f8eQ2mZr71LxT05vKd38WbYp64NcAs1", "q8Zr41LmX0pT77VbN2cK9w"
    texts = [
        '{"token":"' + token + '","user":"alice-example"}', f"Password={long};Application=billing-service", f"AWS_SECRET_KEY={long};region=eu-west-1", f"a=1&api_key={long}&page=2",
        "password = hunter2", "secret tq7Xz9", "the word hunter2 alone", f"x={long}==,y=3",
    ]
    rows = secret_scan.scan(frame(spark, texts)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], {})[r["value"]] = r["secret"]
    assert by[0][token] and by[1][long] and by[2][long] and by[3][long]
    assert "hunter2" in by[4] and "tq7Xz9" in by[5] and 6 not in by and long + "==" in by[7]
