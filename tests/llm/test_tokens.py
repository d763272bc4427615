"""Alignment, mixture packing and collocations against brute force, and their edge cases."""

import random
import struct
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardloom.llm import alignment, mixing, phrases
from cardloom.llm.bytebpe import chunks, is_tame
from cardloom.llm.packing import tokenizer_path
from cardloom.llm.queries import BYTES, PIECES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "\n", " lead", "trail ", "two  blanks", "tab\t x\n y\n\nz", "\r\n;\r x", "nb\u00a0sp", "\x1c a\x85b", "▁ a", "日本語 text", "😀 <|endoftext|> <s> <0x0A>", "it's we'll 12² ¼", "word " * 20_000]


def frame(spark, rows, parts=3):
    df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, (t, lang, s) in enumerate(rows)], DOCS).repartition(parts, "doc_id")
    # names that the operators use themselves
    return df.withColumns({c: F.lit(1) for c in ("key", "pair", "links", "queue", "part", "n", "ids", "word", "f", "rank", "score", "docs")})


def mixed(n, seed):
    rng = random.Random(seed)
    letters = list("abcdeé  \n'") + ["the ", "ing ", ", ", "1", "ß"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_chunks_join_to_the_text():
    for t in [t for t in ODD if t] + mixed(300, 1):
        assert not is_tame(t) or "".join(chunks(t)) == t


# ---- alignment


def brute_alignment(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text, straight from byte spans."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(tokenizer_path(BYTES)), SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    a.encode_special_tokens = True
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    found = []
    for t in texts:
        full = (" " + (t or "")).encode()
        ids_a, ids_b = a.encode(" " + (t or ""), add_special_tokens=False).ids, b.encode(t or "")
        raw_a = ["<|endoftext|>".encode() if i == 50256 else bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not t or b"".join(raw_a) != full or b"".join(raw_b) != full:
            found.append(None)
            continue
        at_a, at_b = spans(raw_a), spans(raw_b)
        groups, low = [], 0
        for end in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            own = [",".join(str(i) for i, (s, _) in zip(ids, at, strict=True) if low <= s < end) for ids, at in ((ids_a, at_a), (ids_b, at_b))]
            groups.append("|".join(own))
            low = end
        starts = {}
        for j, (s, e) in enumerate(at_b):
            starts.update(dict.fromkeys(range(s, e), j))
        links = Counter((i, ids_b[j]) for i, (s, e) in zip(ids_a, at_a, strict=True) for j in {starts[x] for x in range(s, e)})
        found.append((len(ids_a), len(ids_b), ";".join(groups), links))
    count = Counter(p for x in found if x for p in x[3])
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for x in found:
        links = x[3] if x else {}
        out.append((x[0], x[1], x[2].count(";") + 1, sum(links.values()), sum(k for p, k in links.items() if count[p] == best[p[0]]), sum(k * count[p] for p, k in links.items()), x[2]) if x else (0,) * 6 + ("",))
    return out


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_alignment(spark, limit):
    import hashlib

    texts = ODD + mixed(150, 2) + ["the same text"] * 5 + ["the same text here"] * 2
    rows = alignment.align_documents(frame(spark, [(t, "en", "s") for t in texts]), BYTES, PIECES, broadcast_pairs=limit).collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert len(rows) == len(texts)
    for i, want in enumerate(brute_alignment(texts)):
        assert got[i] == (*want[:6], hashlib.sha256(want[6].encode()).hexdigest() if want[6] else ""), texts[i]
    assert alignment.align_documents(frame(spark, []), BYTES, PIECES).count() == 0


# ---- mixture


def brute_rounds(totals, weights, capacity, grain):
    """The stream as (source, queue place) pairs: queues that earn, send whole packets and carry what is left."""
    sent, r = [0] * len(totals), 0
    stream = []
    while sent != totals:
        r += 1
        for s, w in enumerate(weights):
            deficit = r * capacity * w // sum(weights) - sent[s]
            while sent[s] < totals[s] and deficit >= min(grain, totals[s] - sent[s]):
                n = min(grain, totals[s] - sent[s])
                stream += [(s, k) for k in range(sent[s], sent[s] + n)]
                sent[s] += n
                deficit -= n
    return stream


@pytest.mark.parametrize("weights", [[700, 250, 30, 20], [1, 1, 1, 1]])
def test_rounds_are_those_of_queues(weights):
    totals = [700, 250, 30, 21]
    rounds = mixing.Rounds(totals, weights, 64, 16)
    place = {}
    for s, n in enumerate(totals):
        for first in range(0, n, 37):
            for start, length, sequence, offset in rounds.pieces(s, first, min(37, n - first)):
                for k in range(length):
                    place[(sequence, offset + k)] = (s, first + start + k)
    stream = brute_rounds(totals, weights, 64, 16)
    assert [place[k] for k in sorted(place)] == stream
    sizes = Counter(k for k, _ in place)
    assert all(n == 64 or n & (n - 1) == 0 for n in sizes.values()) and sum(n < 64 for n in sizes.values()) == bin(len(stream) % 64).count("1")


@pytest.mark.parametrize("targets", [None, {"a": 3, "b": 1, None: 1, "": 5}])
def test_mixture_packing(spark, targets):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    texts = ODD + mixed(200, 4) + ["a passage of some length " * 40] * 30
    docs = [(t, "en", rng.choice(["a", "a", "a", "b", None, ""])) for t in texts]
    rows = mixing.pack_mixture(frame(spark, docs), BYTES, capacity=128, grain=32, targets=targets, broadcast_rows=0 if targets else 100).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTES))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in parts) == struct.pack(f"<{len(ids)}I", *ids)
        assert [r["start"] for r in parts] == [sum(p["length"] for p in parts[:k]) for k in range(len(parts))] and all(r["doc_tokens"] == len(ids) and len(r["ids"]) == 4 * r["length"] for r in parts)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        size = sum(r["length"] for r in own)
        assert [r["offset"] for r in own] == [sum(p["length"] for p in own[:k]) for k in range(len(own))] and size <= 128 and (size == 128 or size & (size - 1) == 0)
    if targets is None:
        # every prefix of the sequences holds each source's share to within a packet and two windows
        total = Counter()
        for i, own in by_doc.items():
            total[docs[i][2]] += own[0]["doc_tokens"]
        seen = Counter()
        for k in sorted(by_sequence):
            for r in by_sequence[k]:
                seen[docs[r["doc_id"]][2]] += r["length"]
            for s, n in total.items():
                assert abs(seen[s] - sum(seen.values()) * n / sum(total.values())) <= 32 + 2 * 128
    with pytest.raises(ValueError):
        mixing.pack_mixture(frame(spark, docs), BYTES, targets={"a": 1})
    with pytest.raises(ValueError):
        mixing.pack_mixture(frame(spark, docs), BYTES, max_sources=2)
    assert mixing.pack_mixture(frame(spark, []), BYTES).count() == 0


def test_checksums_of_pieces(spark, tmp_path):
    frame(spark, [(t, "en", "s") for t in ODD]).write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op12_mixture_packing"](spark, str(tmp_path)).where("length = 1 and doc_tokens = 1").collect():
        assert r["ids_crc32"] == zlib.crc32(bytes(4))


# ---- collocations


def brute_phrases(rows, least, top):
    import re

    counts = {}
    for t, lang, _ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            own.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, own in counts.items():
        n = sum(v for k, v in own.items() if len(k) == 1)
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            cut = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if not any(len(q) > len(p) and inside(q) and 100 * b >= 80 * a for q, b in found.items()):
                scored.append((-cut[0], -a, " ".join(p).encode(), own[p[: cut[1]]], own[p[cut[1] :]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize(("max_words", "max_phrases"), [(1000, 10_000), (1000, 3), (0, 0)])
def test_collocations(spark, max_words, max_phrases):
    rng = random.Random(5)
    words = ["Stone", "RIVER", "light", "über", "a\u00a0b", "cold", "x", "naïve"]
    texts = [(" ".join(rng.choice(words[: rng.randrange(2, 9)]) + rng.choice(["", "", "", ",", "\n", "\t", "  ", "\x1c"]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None]), "s") for _ in range(120)]
    texts += [(None, "en", "s"), ("", None, "s"), (" \t\n", "fr", "s"), ("one two three four five " * 400, "es", "s"), ("tie a, tie b. " * 9, "it", "s")] + [("same row again", "en", "s")] * 12
    got = phrases.collocations(frame(spark, texts), least=8, top=20, max_words=max_words, max_phrases=max_phrases).collect()
    assert sorted(map(tuple, got)) == brute_phrases(texts, 8, 20) and got
    assert phrases.collocations(frame(spark, [])).count() == 0


def test_double_array_holds_what_it_was_given():
    import numpy as np

    rng = np.random.default_rng(6)
    trie = phrases.DoubleArray(400)
    pairs = np.unique(np.minimum(rng.geometric(0.02, 4000), 399) * 400 + rng.integers(0, 400, 4000))
    parents, words = pairs // 400, pairs % 400
    states = trie.add(parents, words)
    assert len(set(states.tolist())) == len(states) and (states >= 400).all()
    assert (phrases.advance(trie.base, trie.check, parents, words) == states).all()
    every = np.arange(400 * 400)
    hit = phrases.advance(trie.base, trie.check, every // 400, every % 400) >= 0
    assert set(every[hit].tolist()) == set(pairs.tolist())
