"""Text normalisation, ids and digests as native columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = r"(?U)[\s\x1c-\x1f]+"
TAG = "<[^>]+>"


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space become one blank; none stays at the ends."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def bounded(c: Column, limit: int) -> Column:
    """Squeezed text cut to `limit` code points; a blank at the cut stays."""
    return F.substring(squeeze(c), 1, limit)


def first_non_empty(*cols: Column) -> Column:
    """The first column that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def card_id(source_url: Column, entry_key: Column) -> Column:
    return F.concat(F.lit("card-"), F.substring(F.sha2(F.concat(source_url, F.lit("\n"), entry_key), 256), 1, 12))


def ascii_json(json: Column) -> Column:
    """JSON text with each character outside blank to tilde as \\uXXXX, by UTF-16 unit."""
    chars = F.regexp_extract_all(json, F.lit("(?s)(.)"), F.lit(1))
    unit = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
    escaped = F.array_join(F.transform(chars, lambda c: F.when(c.rlike("^[ -~]$"), c).otherwise(unit(c))), "")
    return F.when(json.rlike(r"\A[ -~]*\z"), json).otherwise(escaped)


def content_sha256(**fields: Column) -> Column:
    """Digest of the canonical JSON of the fields: sorted keys, no blanks, ASCII only."""
    return F.sha2(ascii_json(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))), 256)


def canonical_array(c: Column) -> Column:
    return F.to_json(c)


def fingerprint(v: Column) -> Column:
    """Equal for variants with equal content, however their keys are ordered."""
    return F.sha2(v.cast("string"), 256)


def bounded_set(a: Column, limit: int) -> Column:
    """Sorted distinct items, the first `limit` of them."""
    return F.slice(F.array_sort(F.array_distinct(a)), 1, limit)


@F.pandas_udf(T.StringType())
def unescape(texts):
    """HTML entities of the whole HTML5 table; Spark has no such function."""
    import html

    return texts.map(lambda t: None if t is None else html.unescape(t))


def plain_text(c: Column) -> Column:
    """Text without HTML: entities first, then tags (so escaped tags go too), then white space."""
    plain = ~c.contains("&")
    return squeeze(F.regexp_replace(F.when(plain, c).otherwise(unescape(F.when(~plain, c))), TAG, " "))


def plain_page(c: Column, entities: Mapping[str, str]) -> Column:
    """The same of a page whose writer ends its entities and uses these alone; what is cut short, or another, stays as it is.

    entities: each with its semicolon, and its character; they are replaced in this order. Runs of ASCII white
    space become one blank, and blanks of any kind go from the ends.
    """
    for entity, char in entities.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, TAG, " "), r"[ \t\n\f\r]+", " "), r"\A\p{Zs}+|\p{Zs}+\z", "")


def fold_accents(c: Column) -> Column:
    """Text without combining marks; Python sees no ASCII text."""
    plain = c.rlike(r"\A[\x00-\x7f]*\z")
    return F.when(plain, c).otherwise(_fold(F.when(~plain, c)))


@F.pandas_udf(T.StringType())
def _fold(texts):
    import unicodedata

    def fold(t):
        if t is None or t.isascii():
            return t
        return "".join(ch for ch in unicodedata.normalize("NFD", t) if not unicodedata.combining(ch))

    return texts.map(fold)
