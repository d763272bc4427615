"""Toxicity by a weighted finite-state pattern grammar.

Three transducers are composed. The lexicon transducer rewrites a text as a
tape of classes: insult, threat, target, negation, reported speech, clause end,
other words. Its insult entries are whole words or stems (which match longer words only); besides a short list
of common ones they are learned from labelled documents. The clause transducer
reads the tape of a whole clause, once backward, to mark what a target follows,
and once forward, and gives each insult or threat one of the forms plain,
targeted, negated, reported and threat. The weight transducer turns the forms of
a document into a score; its weights are fitted by logistic regression, from
priors that make an aimed insult count most and a denied or quoted one least.

Only clauses with an insult or a threat are walked; finding those is one pass
of an Aho-Corasick automaton over the lower-cased text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import fit_logistic, fold, labelled_texts, text_slices

#: Classes of common English words.
INSULTS = ("idiot", "idiots", "moron", "morons", "imbecile", "stupid", "dumb", "worthless", "pathetic", "disgusting", "scum", "trash", "loser", "losers", "clown", "filth", "vermin", "jerk", "bastard", "bitch", "asshole", "retard", "subhuman")
THREATS = ("kill", "hurt", "murder", "shoot", "stab", "beat", "destroy", "strangle", "rape")
WILL = ("will", "shall", "gonna", "ll", "should", "deserve", "want")
TARGETS = ("you", "your", "yours", "yourself", "u", "ur", "they", "them", "he", "she", "him", "her", "those", "these")
NEGATIONS = ("not", "never", "isn", "aren", "wasn", "weren", "don", "doesn", "didn", "without", "hardly")
REPORTS = ("said", "says", "say", "wrote", "writes", "quoted", "reported", "claimed", "called", "alleged", "according")
FORMS = ("plain", "targeted", "negated", "reported", "threat")
TOXIC, CLEAN = 1000, 2000  # most labelled documents to learn from
WORD = re.compile(r"[^\W\d_]+")
CLAUSE_ENDS = ".!?;:\n|"
CLAUSE = re.compile(f"[{CLAUSE_ENDS}]")


def distinct_texts(texts: list[str], least: int = 2, kept: int = 12) -> list[str]:
    """Leaves out texts that share `least` of their `kept` lowest 3-word hashes with one before: copies are not evidence."""
    from zlib import crc32

    seen: dict[int, set[int]] = {}
    out = []
    for n, t in enumerate(texts):
        w = WORD.findall(t.lower())
        low = sorted({crc32(" ".join(w[i : i + 3]).encode()) for i in range(max(1, len(w) - 2))})[:kept]
        shared: dict[int, int] = {}
        for h in low:
            for m in seen.get(h, ()):
                shared[m] = shared.get(m, 0) + 1
        if max(shared.values(), default=0) >= min(least, len(low)):
            continue
        out.append(t)
        for h in low:
            seen.setdefault(h, set()).add(n)
    return out


def learn_lexicon(toxic: list[str], clean: list[str], support: int = 3, odds: float = 8.0, evidence: float = 11.5, longest: int = 9) -> list[tuple[str, bool, float]]:
    """(entry, is a stem, weight) triples that mark toxic documents.

    An entry must occur in `support` toxic documents with as many different
    neighbouring words, so that copies of one document do not count as evidence,
    and be `odds` times as frequent there as in clean documents, by more than
    chance explains (`evidence`: the log-likelihood ratio). Its weight is the
    logarithm of the odds. A stem is counted where a longer word has it, for the
    stem itself may be a common word. Of nested entries that with the most
    evidence stays; a stem with one continuation is that word.
    """
    from collections import Counter, defaultdict
    from math import log

    def entries(words):  # stems end in *
        return {w[:k] + "*" for w in set(words) for k in range(3, min(len(w) - 1, longest) + 1)} | {w for w in words if len(w) >= 3}

    toxic, clean = distinct_texts(toxic), distinct_texts(clean)
    cut = [WORD.findall(t.lower()) for t in toxic]
    in_toxic = Counter(p for words in cut for p in entries(words))
    docs = {p: n for p, n in in_toxic.items() if n >= support}
    del in_toxic
    seen = Counter(p for t in clean for p in entries(WORD.findall(t.lower())) if p in docs)
    share = len(toxic) / (len(toxic) + len(clean))

    def weight(p):
        return log((docs[p] / len(toxic)) / ((seen[p] + 0.5) / len(clean)))

    def ratio(p):
        n, c = docs[p], seen[p]
        q = n / (n + c)
        return n * log(q / share) + (c * log((1 - q) / (1 - share)) if c else 0.0)

    good = {p for p in docs if weight(p) >= log(odds) and ratio(p) >= evidence}
    contexts, ends = defaultdict(set), defaultdict(set)
    for words in cut:
        for i, w in enumerate(words):
            for p in entries((w,)) & good:
                contexts[p].add((words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
                ends[p].add(w)
    out, taken = [], set()
    for p in sorted((p for p in good if len(contexts[p]) >= support), key=lambda p: (-docs[p] * weight(p), p)):
        if any(p[:k] + "*" in taken for k in range(3, len(p))) or p[-1] == "*" and any(x.startswith(p[:-1]) and x != p[:-1] for x in taken):
            continue
        taken.add(p)
        out.append((min(ends[p]), False, weight(p)) if len(ends[p]) == 1 else (p[:-1], True, weight(p)))
    return sorted(out)


class Grammar:
    """The composed transducers; `forms` weighs a text's clauses by form."""

    def __init__(self, learned: list[tuple[str, bool, float]]):
        self.learned = learned
        self._automaton = None

    def __getstate__(self):
        return {"learned": self.learned, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            entries = {(w, False): ("insult", KNOWN) for w in INSULTS} | {(w, False): ("threat", KNOWN) for w in THREATS} | {(w, stem): ("insult", x) for w, stem, x in self.learned}
            words: dict[str, list] = {}
            for (w, stem), (kind, x) in entries.items():
                words.setdefault(w, []).append((stem, kind, x))
            a = ahocorasick.Automaton()
            for w, own in words.items():
                a.add_word(w, (len(w), own))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def hits(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, class, weight) of the lexicon's words, text being lower-cased."""
        found = []
        for end, (n, own) in self.automaton().iter(text):
            start = end - n + 1
            if start and text[start - 1].isalpha():
                continue
            ends = end + 1 == len(text) or not text[end + 1].isalpha()
            best = max((x for x in own if x[0] != ends), key=lambda x: x[2], default=None)
            if best:
                found.append((start, end + 1, best[1], best[2]))
        return found

    def forms(self, text: str) -> list[float]:
        """Summed weights by form, in FORMS' order; a word said again in the same form counts once."""
        text = text.lower()
        weight = [0.0] * len(FORMS)
        said = set()
        done = 0
        hits = sorted(self.hits(text), key=lambda h: h[:2])
        while hits:
            start = hits[0][0]
            low = max(done, *(text.rfind(c, done, start) + 1 for c in CLAUSE_ENDS))
            m = CLAUSE.search(text, start)
            done = m.start() if m else len(text)
            n = next((i for i, h in enumerate(hits) if h[0] >= done), len(hits))
            for word, form, x in clause_forms(lexicon_tape(text, low, done, hits[:n])):
                if (word, form) not in said:
                    said.add((word, form))
                    weight[form] += x
            hits = hits[n:]
        return weight


CLASSES = {w: kind for kind, words in (("will", WILL), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in words}


def lexicon_tape(text: str, low: int, high: int, hits: list) -> list[tuple[str, str | None, float]]:
    """The clause text[low:high] as (class, word, weight); a lexicon word stands before its class as a common word."""
    tape = []
    at = 0
    for m in WORD.finditer(text, low, high):
        while at < len(hits) and hits[at][0] < m.end():
            start, _, kind, x = hits[at]
            tape.append((kind, (w := WORD.match(text, start)) and w.group(), x))
            at += 1
        tape.append((CLASSES.get(m.group(), "other"), None, 0.0))
    return tape


def transitions() -> dict[tuple[frozenset, str, bool], tuple[frozenset, int | None]]:
    """(state, class, whether a target follows) -> (next state, form or None).

    A state is what the clause has said so far. A threat needs a will-word before
    it and a target after it, else it is an ordinary verb.
    """
    from itertools import combinations

    read = ("will", "target", "negation", "report")
    table = {}
    for state in (frozenset(c) for n in range(len(read) + 1) for c in combinations(read, n)):
        for follows in (False, True):
            for kind in read:
                table[state, kind, follows] = (state | {kind}, None)
            table[state, "other", follows] = (state, None)
            told = 2 if "negation" in state else 3 if "report" in state else None
            aimed = 1 if follows or "target" in state else 0
            table[state, "insult", follows] = (state, aimed if told is None else told)
            table[state, "threat", follows] = (state, None if not (follows and "will" in state) else 4 if told is None else told)
    return table


TABLE = transitions()


def clause_forms(tape: list[tuple[str, str | None, float]]) -> list[tuple[str | None, int, float]]:
    """(word, form, weight) of each insult and threat on the whole tape of a clause."""
    follows = [False] * len(tape)
    for i in range(len(tape) - 2, -1, -1):
        follows[i] = follows[i + 1] or tape[i + 1][0] == "target"
    state: frozenset = frozenset()
    out = []
    for (kind, word, x), ahead in zip(tape, follows, strict=True):
        state, form = TABLE[state, kind, ahead]
        if form is not None:
            out.append((word, form, x))
    return out


PRIOR = (1.0, 1.2, 0.1, 0.3, 1.2)  # factors of the forms before any labels are seen
KNOWN = 4.0  # weight of a word of the short list that the labels say nothing about
MOST = 12.0


def features(forms: list[float]) -> list[float]:
    return [min(x, MOST) for x in forms]


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN):
    """(grammar, weights) learned from a bounded sample of the labelled documents given.

    Null labels are left out. Without labels of both kinds the priors hold.
    """
    import numpy as np

    rows = labelled_texts(docs, labels, "toxic", {1: toxic, 0: clean})
    texts = {k: [r["text"] for r in rows if r["toxic"] == k] for k in (0, 1)}
    if not texts[0] or not texts[1]:
        return Grammar([]), [*PRIOR, -3.5]
    grammar = Grammar(learn_lexicon(texts[1], texts[0]))
    x = np.array([features(grammar.forms(t)) for k in (0, 1) for t in texts[k]])
    y = np.array([k for k in (0, 1) for _ in texts[k]])
    # a few invented clauses of each form hold its factor near the prior
    extra = np.eye(len(FORMS)) * KNOWN
    belief = 1 / (1 + np.exp(-(KNOWN * np.array(PRIOR) - 3.5)))
    x = np.vstack([x, extra, extra])
    y = np.concatenate([y, np.ones(len(FORMS)), np.zeros(len(FORMS))])
    w = np.concatenate([np.ones(len(y) - 2 * len(FORMS)), 3 * belief, 3 * (1 - belief)])
    return grammar, fit_logistic(x, y, w, l2=1e-4).tolist()


def score(docs: DataFrame, grammar: Grammar, weights: list[float]) -> DataFrame:
    """docs without text, with score, forms for every whole text; null and empty texts have no clauses.

    Repeated rows and null ids get rows of their own, very long texts are read
    clause by clause, an empty table gives an empty table.
    """
    kept = [c for c in docs.columns if c != "text"]

    def run(batches):
        import math

        import pyarrow as pa

        for batch in batches:
            own = batch.select(kept)
            for first, texts in text_slices(batch):
                forms = [grammar.forms(t) for t in texts]
                z = [sum(a * b for a, b in zip(weights, features(f), strict=False)) + weights[-1] for f in forms]
                s = [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in z]
                yield pa.RecordBatch.from_arrays([*own.slice(first, len(texts)).columns, pa.array(s), pa.array(forms, pa.list_(pa.float64()))], [*kept, "score", "forms"])

    flat = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, flat + "score double, forms array<double>")


def score_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns on folds 0, 1 and 3 of crc32(doc_id) mod 4 and scores all rows of docs, which has text and any other columns."""
    grammar, weights = fit(docs, labels.where(fold("doc_id", 4) != 2))
    return score(docs, grammar, weights)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, forms of each document, by score_rows; other columns are ignored."""
    scored = score_rows(docs.select(F.col("doc_id").cast("long"), "text"), labels)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "forms")
