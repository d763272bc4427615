"""Tagging rules as data, and the columns that apply them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.sources.commits import shared_folder

# Phrases that mark a card with a technique or product, and the
# topic words of contest feeds. They must equal the card format's.
TECHNIQUES: Mapping[str, tuple[str, ...]] = {
    "clickjacking": ("clickjacking",),
    "cookie-parsing": ("cookie", "cookie prefix", "httponly"),
    "cors-misconfiguration": ("cors", "cross-origin resource sharing"),
    "css-injection": ("css injection", "style injection", "css exfiltration"),
    "csrf": ("csrf", "cross-site request forgery"),
    "dns-rebinding": ("dns rebinding",),
    "http-request-smuggling": ("request smuggling", "request tunnelling", "request tunneling", "http desync", "desync"),
    "idor": ("idor", "insecure direct object reference"),
    "insecure-deserialization": ("deserialization", "deserialisation"),
    "jwt": ("jwt", "json web token"),
    "oauth": ("oauth",),
    "open-redirect": ("open redirect", "open redirection"),
    "parser-differential": ("parser discrepanc", "parser-level", "parser differential", "namespace confusion", "attribute pollution"),
    "path-traversal": ("path traversal", "directory traversal", "local file inclusion", "lfi"),
    "prototype-pollution": ("prototype pollution",),
    "race-condition": ("race condition", "toctou"),
    "remote-code-execution": ("remote code execution", "rce"),
    "saml": ("saml",),
    "sql-injection": ("sql injection", "sqli"),
    "ssrf": ("ssrf", "server-side request forgery"),
    "template-injection": ("template injection", "ssti"),
    "timing-attack": ("timing attack", "web timing"),
    "unicode-normalization": ("unicode overflow", "unicode", "codepoint truncation"),
    "url-validation-bypass": ("url validation bypass", "url parser"),
    "waf-bypass": ("waf bypass", "bypass waf", "bypassing wafs", "blocklist"),
    "web-cache-poisoning": ("cache poisoning", "web cache", "cache deception"),
    "websocket": ("websocket",),
    "xss": ("xss", "cross-site scripting", "cross site scripting"),
}
PRODUCTS: Mapping[str, tuple[str, ...]] = {
    "burp-suite": ("burp suite", "burp intruder", "turbo intruder", "burp"),
    "gitlab": ("gitlab",),
    "nuclei": ("nuclei",),
    "php": ("php",),
    "ruby": ("ruby",),
    "ruby-saml": ("ruby-saml",),
    "vs-code": ("vs code", "visual studio code"),
}
TOPICS: Mapping[str, str] = {
    "android": "mobile", "binary": "binary-exploitation", "binary-exploitation": "binary-exploitation", "binaryexploitation": "binary-exploitation",
    "blockchain": "blockchain", "crypto": "cryptography", "cryptography": "cryptography", "forensics": "forensics", "game": "misc", "hardware": "hardware",
    "misc": "misc", "mobile": "mobile", "network": "networking", "networking": "networking", "osint": "osint", "pwn": "binary-exploitation",
    "rev": "reverse-engineering", "reverse": "reverse-engineering", "reverseengineering": "reverse-engineering", "reversing": "reverse-engineering",
    "stegano": "steganography", "steganography": "steganography", "stego": "steganography", "tpm2": "hardware", "web": "web",
}
# End of fixed values.


def phrase_regex(phrases: tuple[str, ...]) -> str:
    """Any of the phrases as whole words (a hyphen belongs to a word), across any white space; Unicode, any case."""
    any_of = "|".join(r"\s+".join(re.escape(w) for w in p.split()) for p in phrases)
    return rf"(?iU)(?<![\w-])(?:{any_of})(?![\w-])"


def match_slugs(hay: Column, dictionary: Mapping[str, tuple[str, ...]]) -> Column:
    """The slugs with a phrase in the text, in the dictionary's order; no shuffle.

    One scan for any phrase at all; only texts that have one are scanned slug by slug.
    """
    some = hay.rlike(phrase_regex(tuple(p for phrases in dictionary.values() for p in phrases)))
    return F.when(some, F.array_compact(F.array(*[F.when(hay.rlike(phrase_regex(p)), F.lit(slug)) for slug, p in dictionary.items()]))).otherwise(F.array().cast("array<string>"))


def extract_cves(hay: Column) -> Column:
    """Distinct CVE ids, upper case, in order of appearance."""
    found = F.regexp_extract_all(hay, F.lit(r"(?iU)(?<![\w-])CVE-(\d{4}-\d{4,})(?![\w-])"), F.lit(1))
    return F.filter(F.array_distinct(F.transform(found, lambda x: F.concat(F.lit("CVE-"), x))), lambda x: x.rlike(r"\A(?U)CVE-\d{4}-\d{4,}\z"))


def topic_slugs(plain: Column) -> Column:
    """Slugs of the known words in a topic list: after `topics:`, up to ` rating:` or the end."""
    listed = F.lower(F.regexp_extract(plain, r"(?iU)topics:\s*(.*?)(?:\s+rating:|\z)", 1))
    slug = F.create_map(*[F.lit(x) for kv in TOPICS.items() for x in kv])
    return F.array_distinct(F.array_compact(F.transform(F.split(listed, r"(?U)[,\s]+"), lambda w: F.try_element_at(slug, w))))


def dictionary_frame(spark, dictionary: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Rows slug, gram: each phrase's words joined by a blank, lower case."""
    return spark.createDataFrame([(slug, " ".join(p.lower().split())) for slug, phrases in dictionary.items() for p in phrases], "slug string, gram string")


def folded(text: Column) -> Column:
    """Lower case, each run of white space one blank."""
    return F.regexp_replace(F.lower(text), r"(?U)\s+", " ")


def match_dictionary(texts: DataFrame, dictionary: DataFrame, max_phrases: int = 200_000) -> DataFrame:
    """Rows id, slug for dictionaries too large for one regex a slug; phrases of any length and any words.

    texts: id, text; dictionary: slug, gram. A phrase matches as phrase_regex would.
    Up to max_phrases phrases are one automaton that every worker builds and that reads each text once, without a shuffle.
    Beyond that, digests of the texts' runs of words meet those of the phrases in a join. Null
    texts and empty phrases match nothing.
    """
    spark = texts.sparkSession
    d = dictionary.select("slug", F.trim(folded(F.col("gram"))).alias("gram")).where(F.length("gram") > 0).distinct()
    t = texts.where("text is not null").select("id", folded(F.col("text")).alias("text"))
    # found once: a dictionary may be derived from a large table
    at = f"{shared_folder(spark)}/phrases-{uuid.uuid4().hex}"
    d.write.parquet(at)
    d = spark.read.schema(d.schema).parquet(at)
    return _by_automaton(t, d) if d.count() <= max_phrases else _by_digests(t, d)


def _by_automaton(t: DataFrame, d: DataFrame) -> DataFrame:
    spark = t.sparkSession
    slugs: dict[str, list[str]] = {}
    for slug, gram in sorted(tuple(r) for r in d.select("slug", "gram").collect()):
        slugs.setdefault(gram, []).append(slug)
    sent = spark.sparkContext.broadcast(slugs)

    def match(batches):
        import re

        import ahocorasick
        import pyarrow as pa

        # what (?U)\\w is elsewhere, and the hyphen
        part = re.compile(r"[\w\-\u0300-\u036f\u200c\u200d]")
        finder = ahocorasick.Automaton()
        for gram in sent.value:
            finder.add_word(gram, gram)
        finder.make_automaton()
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            at, found = [], []
            for k, text in enumerate(texts):
                own = set()
                for end, gram in finder.iter(text) if sent.value else ():
                    begin = end - len(gram)
                    inside = (begin >= 0 and part.match(text[begin])) or (end + 1 < len(text) and part.match(text[end + 1]))
                    if not inside:
                        own.update(sent.value[gram])
                at += [k] * len(own)
                found += sorted(own)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(found, pa.string())], ["id", "slug"])

    return t.mapInArrow(match, f"id {t.schema['id'].dataType.simpleString()}, slug string")


#: Bits of the filter that keeps runs which are no phrase from the join: at least 64 a phrase, up to the last number (32 MB).
_LEAST_BITS, _MOST_BITS = 15, 28
#: Odd multipliers of the two halves of a digest.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _tokens(text: Column) -> Column:
    """A number for each token of a folded text: its words, and each other character by itself; words have odd numbers.

    A phrase is whole tokens wherever it matches, since no word goes on before or after it.
    """
    found = F.regexp_extract_all(text, F.lit(r"(?U)([\w-]+|[^\w-])"), F.lit(1))
    number = lambda x: F.xxhash64(x).bitwiseAND(-2) + F.when(x.rlike(r"(?U)\A[\w-]"), F.lit(1)).otherwise(0)
    return F.transform(found, number)


class _Runs:
    """Digests of any runs of an array of tokens: sums of the tokens, each times a power of an odd number by its place in the run.

    They are differences of sums from the start, taken back to the run's start by the inverse power; all by 2^64.
    """

    def __init__(self, tokens):
        import numpy as np

        self.tokens = tokens.view(np.uint64)
        self.sums, self.back = [], []
        for half, factor in enumerate(_FACTORS):
            x = self.tokens if half == 0 else (self.tokens ^ (self.tokens >> np.uint64(31))) * np.uint64(_FACTORS[0])
            n = len(x)
            power = lambda f, n=n: np.cumprod(np.append(np.uint64(1), np.full(n, f, np.uint64)))
            self.sums.append(np.append(np.uint64(0), np.cumsum(x * power(factor)[:n], dtype=np.uint64)))
            self.back.append(power(pow(factor, -1, 1 << 64)))

    def digest(self, half: int, start, end):
        s = self.sums[half]
        return (s[end] - s[start]) * self.back[half][start]


def _phrase_digests(d: DataFrame) -> DataFrame:
    """Rows slug, size (tokens), h1, h2 of the phrases of d (slug, gram)."""

    def digests(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            tokens = batch.column("tokens")
            ends = tokens.offsets.to_numpy().astype(np.int64)
            runs = _Runs(tokens.values.to_numpy()[: ends[-1]])
            halves = [pa.array(runs.digest(k, ends[:-1], ends[1:]).view(np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("slug"), pa.array(np.diff(ends), pa.int64()), *halves], ["slug", "size", "h1", "h2"])

    return d.select("slug", _tokens(F.col("gram")).alias("tokens")).mapInArrow(digests, "slug string, size long, h1 long, h2 long")


def _by_digests(t: DataFrame, d: DataFrame) -> DataFrame:
    """The texts' runs of tokens, of the sizes that phrases have, meet the phrases by a digest of 128 bits.

    A filter sent to the workers, of bounded size, lets pass the runs whose digest some phrase may have; a
    text gives each such digest once. What it lets pass too much is lost in the join.
    """
    import numpy as np

    spark = t.sparkSession
    at = f"{shared_folder(spark)}/digests-{uuid.uuid4().hex}"
    keyed = _phrase_digests(d)
    keyed.write.parquet(at)
    keyed = spark.read.schema(keyed.schema).parquet(at)
    n, sizes = keyed.agg(F.count("*"), F.array_sort(F.collect_set("size"))).first()
    bits = min(max((64 * n - 1).bit_length(), _LEAST_BITS), _MOST_BITS)
    place = F.shiftrightunsigned("h1", 64 - bits) + 1
    chunks = keyed.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("b")).toArrow()
    filled = np.zeros((1 << bits - _LEAST_BITS, 1 << _LEAST_BITS - 3), np.uint8)
    for k, chunk in zip(chunks.column("k").to_pylist(), chunks.column("b").to_pylist(), strict=True):
        filled[k - 1] = np.frombuffer(chunk, np.uint8)
    sent = spark.sparkContext.broadcast(filled.ravel())

    def found(ends, tokens):
        """Text number and digest halves of the runs of texts that end at these places; each text's digests once."""
        runs, start = _Runs(tokens), np.arange(len(tokens), dtype=np.int64)
        own = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        last, word = ends[1:][own], (tokens & 1).astype(bool)
        # a run may not go on as a word on either side of it
        free = np.append(True, ~word[:-1])
        free[ends[:-1][ends[:-1] < len(free)]] = True
        begins = word | free
        out = []
        for size in sizes:
            at = start[begins & (start + size <= last)]
            h = runs.digest(0, at, at + size)
            place = (h >> np.uint64(64 - bits)).astype(np.int64)
            fits = (sent.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            at, h, end = at[fits], h[fits], at[fits] + size
            after = end < last[at]
            whole = word[end - 1] | ~after | ~word[np.where(after, end, 0)]
            at, h, end = at[whole], h[whole], end[whole]
            out.append((own[at], h, runs.digest(1, at, end)))
        k, a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((b, a, k))
        k, a, b = k[order], a[order], b[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return k[new], a[new].view(np.int64), b[new].view(np.int64)

    def match(batches):
        import pyarrow as pa

        for batch in batches:
            ids, tokens = batch.column("id"), batch.column("tokens")
            ends, values = tokens.offsets.to_numpy().astype(np.int64), tokens.values.to_numpy()
            first = 0
            while first < len(ids):
                # about a million tokens at a time, and at least a text
                past = max(int(np.searchsorted(ends, ends[first] + 1_000_000, "right")) - 1, first + 1)
                k, *halves = found(ends[first : past + 1] - ends[first], values[ends[first] : ends[past]])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(k + first)), *map(pa.array, halves)], ["id", "h1", "h2"])
                first = past

    tokens = t.select("id", _tokens(F.col("text")).alias("tokens"))
    hits = tokens.mapInArrow(match, f"id {t.schema['id'].dataType.simpleString()}, h1 long, h2 long")
    pairs = hits.join(keyed.select("slug", "h1", "h2"), ["h1", "h2"]).select("id", "slug")
    # rows differ already where each text has its own id and each phrase its own slug
    twice = [df.groupBy(c).agg(F.count("*").alias("n")).where("n > 1") for df, c in ((t, "id"), (keyed, "slug"))]
    return pairs if all(df.isEmpty() for df in twice) else pairs.distinct()
