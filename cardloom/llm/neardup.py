"""MinHash near-duplicate groups.

Documents with equal shingle sets are one set first. Each distinct set gets
`bands * rows` minima of universal hashes; sets that agree in a band share a
bucket. A bucket links its members to its smallest id (a star); each star pair
is confirmed on the full sets, and connected components of the confirmed links
come from alternating large-star and small-star. Where a bucket still holds
several components, the sets in it are joined by their rarest shingles (a prefix
join), so that a passage that many texts share makes no pairs; what shares one is
compared by signature, and then on the full sets. No bucket is capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import cut_lineage, gathered, text_slices

BANDS, ROWS, WORDS, PERCENT = 32, 4, 5, 75
CELLS = 1 << 20  # classes of shingle hashes whose counts order them from rare to common
_words: dict[bytes, int] = {}


def word_hashes(texts: list[str], cached: int = 500_000):
    """(hashes of all words, number of words of each text)."""
    import numpy as np
    import xxhash

    if len(_words) > cached:
        _words.clear()
    cut = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]  # bytes: A-Z and ASCII white space only
    for own in cut:
        for w in own:
            if w not in _words:
                _words[w] = xxhash.xxh3_64_intdigest(w)
    count = np.fromiter(map(len, cut), np.int64, len(cut))
    flat = np.fromiter((_words[w] for own in cut for w in own), np.uint64, int(count.sum()))
    return flat, count


def shingle_sets(texts: list[str], words: int = WORDS):
    """The sorted distinct 64-bit shingle hashes of each text; of a shorter text its whole sequence's."""
    import numpy as np

    flat, count = word_hashes(texts)
    rng = np.random.default_rng(5)
    odd = rng.integers(1, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def mixed(h):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    n = max(0, len(flat) - words + 1)
    h = np.zeros(n, np.uint64)
    for i in range(words):
        h += flat[i : i + n] * odd[i]
    h = mixed(h)
    out, at = [], 0
    for c in count:
        if c >= words:
            out.append(np.unique(h[at : at + c - words + 1]))
        elif c:
            out.append(mixed((flat[at : at + c] * odd[:c]).sum(keepdims=True) + np.uint64(c)))
        else:
            out.append(flat[:0])
        at += c
    return out


def minima(sets: list, size: int):
    """uint32 matrix: for each non-empty set the least value of each universal hash."""
    import numpy as np

    rng = np.random.default_rng(10)
    a = rng.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, size, dtype=np.uint64)
    out = np.empty((len(sets), size), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= 32_768):
            total += len(sets[last])
            last += 1
        flat = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first : last - 1]])
        for i in range(size):
            out[first:last, i] = np.minimum.reduceat(((flat * a[i] + b[i]) >> np.uint64(32)).astype(np.uint32), starts)
        first = last
    return out


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """Rows doc_id, n_shingles, set_key (128-bit hash of the set, null if empty), sig (minima, 4 bytes each)."""

    def sign(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            own = batch.column("doc_id")
            for first, texts in text_slices(batch):
                sets = shingle_sets(texts, words)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = minima([sets[i] for i in full], bands * rows) if full else np.empty((0, 1), np.uint32)
                key: list = [None] * len(sets)
                sigs: list = [None] * len(sets)
                for k, i in enumerate(full):
                    key[i], sigs[i] = xxhash.xxh3_128_digest(sets[i].tobytes()), sig[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [own.slice(first, len(texts)), pa.array([len(s) for s in sets], pa.int64()), pa.array(key, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "sig"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, sig binary")


def full_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows id, shingles."""

    def build(batches):
        import pyarrow as pa

        for batch in batches:
            own = batch.column("doc_id")
            for first, texts in text_slices(batch):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays([own.slice(first, len(texts)), pa.array([s.view("int64") for s in sets], pa.list_(pa.int64()))], ["id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, "id long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT, share: int = 4096) -> DataFrame:
    """The pairs (a, b) whose full sets (id, shingles) reach the threshold.

    A set travels once for each pair. The pairs of a common `a` are dealt, by
    their other end, over one copy of its set for every `share` pairs.
    """
    copies = pairs.groupBy("a").agg(F.ceil(F.count("*") / share).cast("int").alias("copies"))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")).join(copies, "a").select("a", "sa", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    dealt = pairs.join(copies, "a").withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int")).drop("copies")
    both = dealt.join(left, ["a", "copy"]).join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """Rows id, component (smallest id reachable) of all ids in links (a, b).

    Large-star: each node sends its larger neighbours to the least of its
    neighbours and itself. Small-star: each node sends its smaller neighbours,
    and itself, there. Alternated until neither changes an edge.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = near.join(least, "a")
        if large:
            new = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return new.where("a <> b").distinct()

    def state(edges: DataFrame):
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    while before[0]:
        edges = gathered(edges, before[0])
        edges = cut_lineage(gathered(star(star(edges, True), False), 2 * before[0]))
        after = state(edges)
        if after == before:
            break
        before = after
    least = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return gathered(least.union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()), 2 * before[0])


def sets_of(ids: DataFrame, docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows id, shingles of the documents in ids (doc_id)."""
    texts = docs.select("doc_id", "text").join(ids.distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return cut_lineage(full_sets(texts, words))


def shingle_counts(sets: DataFrame):
    """uint32 array: how many of the sets' shingles fall in each of CELLS classes of hashes; its size is fixed."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            total += np.bincount(cell(batch.column("shingles").flatten().to_numpy().view(np.uint64)), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["cell", "n"])

    rows = sets.select("shingles").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.uint32)
    out[rows.column("cell").to_numpy()] = np.minimum(rows.column("n").to_numpy(), 2**32 - 1)
    return out


def cell(shingles):
    return (shingles >> 44).astype("int64")


def prefixes(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows token, id, n, pos: the necessary prefix of each set under the order from rare to common shingles.

    Two sets at the threshold share a shingle of both prefixes. The order follows
    counts by class of hashes, which is as good as any for right results. A class
    that is counted once holds a shingle of one set only, and is left out.
    """
    counts = sets.sparkSession.sparkContext.broadcast(shingle_counts(sets))

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        often = counts.value
        for batch in batches:
            ids, tokens, sizes, places = [], [], [], []
            for i, s in zip(batch.column("id").to_pylist(), batch.column("shingles"), strict=True):
                s = np.asarray(s.values).view(np.uint64)
                n = len(s)
                f = often[cell(s)]
                first = np.lexsort((s, f))[: n - (percent * n + 99) // 100 + 1]
                at = np.flatnonzero(f[first] > 1)
                ids.append(np.full(len(at), i))
                sizes.append(np.full(len(at), n))
                tokens.append(s[first[at]].view(np.int64))
                places.append(at)
            cols = [np.concatenate(x).astype(t) for x, t in ((tokens, "int64"), (ids, "int64"), (sizes, "int32"), (places, "int32")) if x]
            if cols:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), ["token", "id", "n", "pos"])

    return sets.select("id", "shingles").mapInArrow(cut, "token long, id long, n int, pos int")


def alike(pairs: DataFrame, sigs: DataFrame, size: int, least: float = 0.5625) -> DataFrame:
    """The pairs whose minima agree in `least` of the places; with 128 minima a pair at 0.75 falls short with a chance of about one in a million."""

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, size) for c in ("ga", "gb"))
            yield batch.select(["a", "b"]).filter(pa.array((one == two).sum(1) >= least * size))

    both = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("ga")), "a").join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("gb")), "b")
    return both.select("a", "b", "ga", "gb").mapInArrow(compare, "a long, b long")


def joined_leftovers(members: DataFrame, joined: DataFrame, sigs: DataFrame, docs: DataFrame, size: int, words: int = WORDS, percent: int = PERCENT, centres: int = 1024) -> DataFrame:
    """joined (id, component) with what the stars left apart: exactly, by a prefix join of the sets in mixed buckets.

    A prefix token's sets that lie in one component need no comparison. Of the
    others, those outside the token's largest component are centres, some hundreds at a
    time; each is compared with the token's sets of other components that length
    and place in the prefix allow, and then is done there. Components are
    contracted after each turn, and turns go on until no token has two
    components left, so every pair is compared or joined. Shingles that many
    texts share come last in the order and are in few prefixes.
    """
    known = members.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = known.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    ids = members.join(mixed.select("bucket"), "bucket", "left_semi").select(F.col("id").alias("doc_id"))
    sets = sets_of(ids, docs, words)
    if sets.isEmpty():
        return joined
    left = cut_lineage(prefixes(sets, percent))
    rows = left.count()
    left = gathered(left, rows)
    while True:
        u = left.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
        home = u.groupBy("token", "component").agg(F.count("*").alias("k")).groupBy("token").agg(F.max_by("component", F.struct("k", "component")).alias("home"), (F.sum("k") - F.max("k")).alias("rest"))
        u = cut_lineage(gathered(u.join(home.where("rest > 0"), "token"), rows))
        rows = u.count()
        if not rows:
            return joined
        slot = F.pmod(F.xxhash64("id", "token"), F.least(8 * F.col("rest"), F.lit(centres)))
        some = u.where("component <> home").groupBy("token", slot.alias("slot")).agg(F.min(F.struct("id", "n", "pos", "component")).alias("c"))
        some = cut_lineage(gathered(some.groupBy("token").agg(F.collect_list("c").alias("cs")), rows))  # at most `centres` of them

        def fits(c):
            # what the two can still share from here on, this being their first common shingle
            rest = F.least(F.col("n") - F.col("pos"), c["n"] - c["pos"])
            return (c["component"] != F.col("component")) & ((100 + percent) * rest >= percent * (F.col("n") + c["n"]))

        # a pair may share many prefix tokens: each set's centres are made distinct before they become rows
        found = u.join(some, "token").select("id", F.transform(F.filter("cs", fits), lambda c: c["id"]).alias("others")).where(F.size("others") > 0)
        each = found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
        pairs = each.select("id", F.explode("others").alias("other"))
        pairs = cut_lineage(pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())
        n = pairs.count()
        # not gathered: few pairs would bring the signatures or sets of all to few tasks
        near = cut_lineage(alike(gathered(pairs, n), sigs, size))
        more = cut_lineage(confirmed(near, sets, percent))
        if not more.isEmpty():
            joined = cut_lineage(components(more.union(joined.select(F.col("component").alias("a"), F.col("id").alias("b")))))
        done = some.select("token", F.explode("cs.id").alias("id"))
        left = u.select("token", "id", "n", "pos").join(done, ["token", "id"], "left_anti")


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows doc_id, n_shingles, component_id, kept for each row of docs.

    Null and empty texts, and texts without words, have no shingles and stay
    alone. Repeated rows are alike: each is kept if its id is its component's
    smallest. doc_id is the key: rows that share it must share their text (where
    they do not, their components are joined). Rows with a null doc_id are linked
    with nothing, and kept. Very long texts are hashed whole, a slice of a batch
    at a time. An empty table gives an empty table; other columns are ignored.
    """
    signed = cut_lineage(signatures(docs, bands, rows, words))
    known = signed.where("set_key is not null and doc_id is not null")
    sets = cut_lineage(known.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")))
    part = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * (4 * rows) + 1, F.lit(4 * rows))))
    banded = sets.select("id", F.explode(part).alias("bucket"))
    centres = banded.groupBy("bucket").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last").select("bucket", "centre")
    members = cut_lineage(banded.join(centres, "bucket"))
    stars = cut_lineage(members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct())
    full = sets_of(stars.select(F.col("a").alias("doc_id")).union(stars.select(F.col("b").alias("doc_id"))), docs, words)
    joined = cut_lineage(components(cut_lineage(confirmed(stars, full, percent))))
    joined = joined_leftovers(members.select("id", "bucket"), joined, sets.select("id", "sig"), docs, bands * rows, words, percent)
    whole = known.join(sets.select("set_key", "id"), "set_key").join(joined, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component")).groupBy("doc_id").agg(F.min("component").alias("component_id"))
    out = signed.join(whole, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
