"""Secret scan with a random forest against false positives.

Candidates are the values in the words of a text, as white space parts it: each
word is cut at = : ; , & and quotes. A value counts if it is long and holds a
digit, or stands next to a key word. Each is described by its length, the changes between letters and
digits, how likely its letters follow each other in the corpus's own words, its
case and alphabet, how much of it such words cover, whether it looks like a
path, address or number, and the words before and after it. A random forest
trained on labelled findings tells secrets from the rest.

Everything is DataFrame operations and the library's own forest; no Python runs
on executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut_lineage

LEAST_CHARS = 12
EXAMPLES = 4000  # labelled findings to learn from
TREES, DEPTH = 24, 8
LETTERS = 26
SALTS = 16  # parts in which a word of many values, or a value of many rows, is joined

#: Words that stand before secrets, and before harmless strings of the same looks.
KEYS = ("token", "password", "passwd", "pwd", "secret", "api_key", "apikey", "api-key", "key", "auth", "authorization", "bearer", "credential", "private")
HARMLESS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "digest", "uuid", "guid", "id", "version", "build", "isbn", "order", "page", "phone", "card", "file", "path", "url", "see", "example", "revision", "item")
COMMON = ("the", "and", "ing", "tion", "that", "with", "from", "this", "file", "page", "test", "data", "user", "name", "example", "sample", "version", "model", "image", "index", "report", "license", "chapter", "server", "table", "value", "key", "token", "pass", "word", "secret")


def words(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")


def is_key(word: Column) -> Column:
    """Whether the word is a key word, or a name that ends in one."""
    return F.lower(word).rlike(rf"(?:^|[^a-z0-9])(?:{'|'.join(KEYS)})[^a-z0-9]*$")


def stripped(value: Column) -> Column:
    """The value without punctuation around it."""
    return F.regexp_replace(value, r"^[^A-Za-z0-9]+|[^A-Za-z0-9=]+$", "")


def values(word: Column) -> Column:
    """Every value in a word: structs own (the name before it, or ''), raw, local (the value with its name and marks)."""

    def of_item(item):
        # a = that ends the value is padding
        parts = F.filter(F.split(item, "[:\"']|=(?![=\"']|$)"), lambda x: x != "")
        n = F.size(parts)

        def of_part(x, k):
            own = F.when(k > 0, F.get(parts, k - 1)).otherwise("")
            mark = F.when(x.startswith("//"), ":").otherwise("=")
            return F.struct(own.alias("own"), x.alias("raw"), F.when(n <= 2, item).otherwise(F.concat(own, F.when(k > 0, mark).otherwise(""), x)).alias("local"))

        return F.transform(parts, of_part)

    return F.flatten(F.transform(F.split(word, "[;,&]"), of_item))


def candidates(docs: DataFrame) -> DataFrame:
    """Rows doc_id, th, pos (word number), part (value number in it), value, word, before, before2, after."""
    w = F.col("w")
    near = lambda i: F.lower(F.coalesce(F.get(w, i), F.lit("")))
    follows = lambda one, two: is_key(one) | (one.isin("=", ":", "=>", ":=", "is") & is_key(two))
    inside = rf"(?i)(?:{'|'.join(KEYS)})[^A-Za-z0-9]*[=:]"
    # the cheap tests first: most words end at their length
    at = F.filter(
        F.sequence(F.lit(0), F.size("w") - 1),
        lambda i: ((F.length(F.get(w, i)) >= LEAST_CHARS) & F.get(w, i).rlike("[0-9]")) | (F.get(w, i).rlike("[=:]") & F.get(w, i).rlike(inside)) | ((i > 0) & follows(near(i - 1), near(i - 2))),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w"))
    found = F.transform(at, lambda i: F.struct(i.alias("pos"), F.get(w, i).alias("whole"), near(i - 1).alias("before"), F.when(i > 1, near(i - 2)).otherwise("").alias("before2"), near(i + 1).alias("after")))
    out = rows.select("doc_id", "th", F.explode(found).alias("c")).select("doc_id", "th", "c.*")
    out = out.select("*", F.posexplode(values(F.col("whole"))).alias("part", "v")).withColumns({"value": stripped(F.col("v.raw")), "word": F.col("v.local")})
    named = F.col("v.own") != ""
    keyed = F.when(named, is_key(F.col("v.own"))).otherwise((F.col("part") == 0) & follows(F.col("before"), F.col("before2")))
    out = out.where(((F.length("value") >= LEAST_CHARS) & F.col("value").rlike("[0-9]")) | (keyed & (F.col("value") != "")))
    # the neighbours of a later value are in its own word
    first = F.col("part") == 0
    return out.select("doc_id", "th", "pos", "part", "value", "word", F.when(first, F.col("before")).otherwise("").alias("before"), F.when(first, F.col("before2")).otherwise("").alias("before2"), "after")


def vocabulary(docs: DataFrame, documents: int = 3) -> DataFrame:
    """Rows run: words of three letters or more, with nothing else in them, that so many texts hold, and the words named above."""
    own = F.regexp_extract_all(F.col("text"), F.lit(r"""(?<![^\s"'(])\p{Lu}?\p{Ll}{2,}(?![^\s.,;:!?"')])"""), F.lit(0))
    held = docs.select(F.explode(F.array_distinct(F.transform(own, F.lower))).alias("run")).where("length(run) > 2")
    often = held.groupBy("run").agg(F.count("*").alias("n")).where(F.col("n") >= documents).select("run")
    named = sorted({part for w in (*KEYS, *HARMLESS, *COMMON) for part in w.replace("_", "-").split("-") if part.isalpha() and len(part) > 2})
    return often.union(docs.sparkSession.createDataFrame([(w,) for w in named], "run string")).distinct()


def transitions(known: DataFrame) -> list[float]:
    """Log of the share of each letter after each in the words (run): LETTERS * LETTERS values, whatever the corpus."""
    import math

    pair = F.transform(F.sequence(F.lit(1), F.length("run") - 1), lambda i: F.col("run").substr(i, F.lit(2)))
    rows = known.select(F.explode(pair).alias("pair")).where(F.col("pair").rlike("^[a-z]{2}$")).groupBy("pair").count().collect()
    n = [1.0] * (LETTERS * LETTERS)
    for r in rows:
        n[(ord(r["pair"][0]) - 97) * LETTERS + ord(r["pair"][1]) - 97] += r["count"]
    total = [sum(n[k : k + LETTERS]) for k in range(0, len(n), LETTERS)]
    return [math.log(c / total[k // LETTERS]) for k, c in enumerate(n)]


def covered(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows with coverage: the share of value in runs of letters that are known words.

    Each distinct value is looked up once. Words and answers are dealt over SALTS
    parts, so that neither a word of very many values nor a value of very many
    rows is a hot key.
    """
    runs = F.split(F.lower(F.regexp_replace("value", r"(\p{Ll})(\p{Lu})", "$1 $2")), r"[^\p{L}]+")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    parts = rows.select("value").distinct().select("value", F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int").alias("salt"), F.explode(F.filter(runs, lambda r: F.length(r) > 2)).alias("run"))
    found = parts.join(known.select("run", every), ["run", "salt"]).groupBy("value").agg((F.sum(F.length("run")) / F.greatest(F.length("value"), F.lit(1))).alias("coverage"))
    dealt = found.select("*", every)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*[c for c in ("doc_id", "th", "pos", "word") if c in rows.columns]), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, ["value", "salt"], "left").drop("salt").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def features(rows: DataFrame, likely: list[float]) -> DataFrame:
    """rows with a vector column features, from value, word, before, before2, after and coverage."""
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1))
    kind = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    changes = F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(kind, "A+", "A"), "a+", "a"), "0+", "0"))
    share = lambda p: F.length(F.regexp_replace(v, f"[^{p}]", "")) / n
    bare = lambda c: F.regexp_replace(c, "[^a-z0-9_-]", "")
    own_key = F.regexp_extract(F.lower("word"), r"([a-z0-9_-]+)[\"']?[=:][\"']?[^=:]", 1)
    ends = lambda c, words: c.rlike(rf"(?:^|[_-])(?:{'|'.join(words)})$")
    keyed = lambda words: ends(bare(F.col("before")), words) | ends(bare(F.col("before2")), words) | ends(own_key, words)
    yes = lambda c: c.cast("double")
    low = F.lower(v)
    logs = F.array(*map(F.lit, likely))
    letter = lambda i: F.ascii(low.substr(i, F.lit(1))) - 97
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(v) - 1, F.lit(1))), lambda i: low.substr(i, F.lit(2)).rlike("^[a-z]{2}$"))
    follow = F.aggregate(F.transform(at, lambda i: F.get(logs, letter(i) * LETTERS + letter(i + F.lit(1)))), F.lit(0.0), lambda a, x: a + x)
    cols = [
        F.length(v), changes, changes / n, share("0-9"), share("A-Z"), share("a-z"), share("a-fA-F0-9"), share("^A-Za-z0-9"),
        F.size(F.array_distinct(F.split(v, ""))) / n,
        F.col("coverage"), F.when(F.size(at) > 0, follow / F.size(at)).otherwise(-4.0),
        yes(v.rlike("^[0-9a-f]{32,}$")), yes(v.rlike("^(AKIA|ASIA)[A-Z0-9]{12,}$|^gh[pousr]_|^sk-|^xox[abp]-|^eyJ")),
        yes(v.rlike(r"^[0-9 .,:/()+-]+$")), yes(v.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")),
        F.length(F.regexp_replace("word", "[^/\\\\]", "")), yes(F.col("word").rlike(r"@|://|\.(com|org|net|html?|png|jpe?g|pdf|txt|csv)\b")),
        yes(F.col("word").contains("=")), yes(F.col("before").isin("=", ":", "=>", ":=")), yes(keyed(KEYS)), yes(keyed(HARMLESS)),
        yes(ends(bare(F.col("after")), HARMLESS)), yes(ends(bare(F.col("after")), KEYS)),
        yes(F.col("word").rlike("[\"']")), yes(low.rlike(r"(.)\1{4}|example|placeholder|changeme|redacted|12345678")),
    ]
    return rows.withColumn("features", array_to_vector(F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])))


def labelled_findings(spark: SparkSession, n: int = EXAMPLES) -> DataFrame:
    """n labelled findings by rule, half secrets; columns as of candidates, and label.

    Values are cut from hashes of the row number, so they are the same on every
    run and no real secret is among them.
    """
    i = F.col("id")
    h = F.sha2(i.cast("string"), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(h)), "[+/=]", "x")
    pick = lambda words, by: F.element_at(F.array(*map(F.lit, words)), (by % len(words) + 1).cast("int"))
    r, kind = F.pmod(F.xxhash64("id"), F.lit(1 << 30)), F.pmod(F.xxhash64("id", F.lit("kind")), F.lit(11)).cast("int")
    key = pick(KEYS, r)
    plain = pick(COMMON[:13], r)
    cut = lambda s, low, more: F.substring(s, F.lit(1), (low + r % more).cast("int"))
    short = F.concat(plain, cut(b64, 2, 4), (r % 90).cast("string"))
    quoted = lambda v: F.concat(F.lit('"'), v, F.lit('"'))
    finding = lambda *c: F.struct(*[x.alias(name) for x, name in zip(c, ("value", "word", "before", "before2"), strict=True)])
    secret = (
        F.when(kind == 0, finding(F.substring(h, 1, 40), quoted(F.substring(h, 1, 40)), F.lit("="), key))
        .when(kind == 1, finding(cut(h, 16, 25), F.concat(key, F.lit("="), cut(h, 16, 25)), plain, plain))
        .when(kind == 2, finding(F.concat(F.lit("AKIA"), F.upper(F.substring(b64, 1, 16))), F.concat(F.lit("AKIA"), F.upper(F.substring(b64, 1, 16))), plain, plain))
        .when(kind == 3, finding(F.concat(F.lit("ghp_"), F.substring(b64, 1, 36)), F.concat(F.lit("ghp_"), F.substring(b64, 1, 36)), plain, plain))
        .when(kind == 4, finding(cut(b64, 16, 24), quoted(cut(b64, 16, 24)), F.lit(":"), key))
        .when(kind == 5, finding(cut(b64, 14, 20), F.concat(key, F.lit(":"), cut(b64, 14, 20)), plain, plain))
        .when(kind == 6, finding(cut(b64, 20, 20), cut(b64, 20, 20), F.concat(key, F.lit(":")), plain))
        .when(kind == 7, finding(F.concat(F.lit("sk-"), cut(b64, 24, 16)), F.concat(F.lit("sk-"), cut(b64, 24, 16)), plain, plain))
        .when(kind == 9, finding(short, short, F.lit("="), key))
        .when(kind == 10, finding(short, F.concat(key, F.lit("="), short), plain, plain))
        .otherwise(finding(cut(h, 24, 17), cut(h, 24, 17), F.lit("="), key))
    )
    other = pick(HARMLESS, r)
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    number = F.lpad((r * 7919 % 10_000_000_000).cast("string"), 16, "4539148803436467")
    path = F.concat(F.lit("/usr/"), plain, F.lit("/"), other, F.lit("-"), (r % 90).cast("string"), F.lit(".txt"))
    made = F.concat(plain, other, plain, (r % 2030).cast("string"))
    mail = F.concat(plain, F.lit("."), (r % 99).cast("string"), F.lit("@mail.example.com"))
    symbols = F.concat(plain, F.lit("."), F.substring(h, 1, 4), F.lit("!!"), other)
    blank = F.concat(pick(("xxxxxxxx", "example-", "changeme", "00000000", "redacted"), r), (r % 100000).cast("string"), F.lit("0000"))
    harmless = (
        F.when(kind == 0, finding(F.substring(h, 1, 40), F.substring(h, 1, 40), pick(("commit", "sha1", "revision", "checksum"), r), plain))
        .when(kind == 1, finding(uuid, uuid, other, plain))
        .when(kind == 2, finding(number, number, plain, plain))
        .when(kind == 3, finding(path, path, other, plain))
        .when(kind == 4, finding(made, made, plain, other))
        .when(kind == 5, finding(mail, mail, plain, plain))
        .when(kind == 6, finding(blank, F.concat(key, F.lit("="), blank), plain, plain))
        .when(kind == 7, finding(symbols, symbols, plain, other))
        .when(kind == 9, finding(plain, plain, key, other))
        .when(kind == 10, finding(other, F.concat(key, F.lit(":"), other), plain, plain))
        .otherwise(finding(F.md5(h), F.concat(F.lit("md5:"), F.md5(h)), pick(("md5", "digest", "hash"), r), plain))
    )
    rows = spark.range(n).withColumns({"label": (i % 2 == 0).cast("double"), "c": F.when(i % 2 == 0, secret).otherwise(harmless)})
    # a harmless string is named on either side, a secret is mostly followed by prose
    after = F.when((i % 2 == 1) & (r % 3 == 0), other).when(r % 2 == 0, plain).when(r % 11 == 0, key).otherwise("")
    return rows.select("label", "c.*", after.alias("after"))


def train(findings: DataFrame, known: DataFrame, likely: list[float]) -> RandomForestClassificationModel:
    """A forest from labelled findings (value, word, before, before2, after, label)."""
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=8, labelCol="label", featuresCol="features").fit(features(covered(findings, known), likely))


def scan(docs: DataFrame, findings: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """Rows doc_id, th, pos, part, value, score, secret for every candidate of every whole text.

    Null and empty texts have no candidates. Repeated rows give repeated
    candidates; rows with a null doc_id are scanned too. Other columns are
    ignored. An empty table gives an empty table. Words are counted over all
    texts; of the counts only those of pairs of letters reach the driver.
    """
    known = cut_lineage(vocabulary(docs))
    likely = transitions(known)
    model = train(labelled_findings(docs.sparkSession) if findings is None else findings, known, likely)
    scored = model.transform(features(covered(cut_lineage(candidates(docs)), known), likely))
    score = vector_to_array("probability")[1]
    return scored.select("doc_id", "th", "pos", "part", "value", score.alias("score"), (score >= least).alias("secret"))


def scan_documents(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, n_candidates, n_secrets, max_score, secrets_sha256.

    secrets_sha256 is over the secrets in the order of their places, joined by
    newlines. Rows that share doc_id and text get equal results.
    """
    found = scan(docs).distinct().groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(
        F.count("*").alias("n_candidates"), F.count_if("secret").alias("n_secrets"), F.max("score").alias("max_score"),
        F.array_sort(F.collect_list(F.when(F.col("secret"), F.struct("pos", "part", "value")))).alias("own"),
    )
    keys = docs.select("doc_id", F.xxhash64("text").alias("th"))
    out = keys.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("t")), "left")
    zero = F.lit(0).cast("long")
    joined = F.array_join(F.transform(F.coalesce("own", F.array().cast("array<struct<pos:int,part:int,value:string>>")), lambda s: s["value"]), "\n")
    return out.select("doc_id", F.coalesce("n_candidates", zero).alias("n_candidates"), F.coalesce("n_secrets", zero).alias("n_secrets"), F.coalesce("max_score", F.lit(0.0)).alias("max_score"), F.sha2(joined, 256).alias("secrets_sha256"))
