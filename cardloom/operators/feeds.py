"""Feed bodies to entries: RSS items and Atom entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.text import bounded
from cardloom.functions.urls import safe_article_url

FIELDS = ("entry_key", "title", "summary", "link", "published")
#: For each kind of feed: its root, the path of its entries, and each field's names, the first that is not empty counts.
#: A name with @ is an attribute; entry_key falls back to the link and then to the title.
KINDS = {
    "rss": ("channel/item", {"entry_key": ("guid",), "title": ("title",), "summary": ("description",), "link": ("link",), "published": ("pubDate",)}, False),
    "feed": ("entry", {"entry_key": ("id",), "title": ("title",), "summary": ("summary", "content"), "link": ("link@href",), "published": ("published", "updated")}, True),
}
_ENTRY = "struct<" + ", ".join(f"{f}: string" for f in FIELDS) + ">"


def local_name(element) -> str:
    return element.tag.split("}")[-1] if isinstance(element.tag, str) else ""


def values_of(entry) -> dict[str, str]:
    """The first text of each child name, white space collapsed, and the first non-empty value of each of its attributes."""
    out: dict[str, str] = {}
    for child in entry:
        name = local_name(child)
        out.setdefault(name, " ".join("".join(child.itertext()).split())[:10_000])
        for key, value in child.items():
            if value:
                out.setdefault(f"{name}@{key}", value)
    return out


def entries_of(body: bytes, most: int) -> tuple[str | None, list[dict[str, str]]]:
    """(reason, []) for a body that is no feed, else (None, raw entries in document order)."""
    from xml.etree import ElementTree

    if b"<!doctype" in body.lower():
        return "malformed_xml", []
    try:
        root = ElementTree.fromstring(body)
    except (ElementTree.ParseError, ValueError):
        return "malformed_xml", []
    if local_name(root) not in KINDS:
        return "unsupported_feed", []
    path, names, any_namespace = KINDS[local_name(root)]
    found = [e for e in root if local_name(e) == path] if any_namespace else root.findall(path)
    rows = []
    for own in map(values_of, found[:most]):
        row = {f: next((own[n] for n in names[f] if own.get(n)), "") for f in FIELDS}
        row["entry_key"] = row["entry_key"] or row["link"] or row["title"]
        rows.append(row)
    return None, rows


def parse_bodies(responses: DataFrame) -> DataFrame:
    """responses (with content and max_entries) with reason and entries appended.

    A null content gives a null in both; a body that is no feed gives a reason
    and no entries.
    """

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([(k, pa.string()) for k in FIELDS]))
        for batch in batches:
            bodies, most = batch.column("content"), batch.column("max_entries").to_pylist()
            parsed = [entries_of(b.as_py(), n) if b.is_valid else (None, None) for b, n in zip(bodies, most, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r for r, _ in parsed], pa.string()), pa.array([e for _, e in parsed], kind)], [*batch.schema.names, "reason", "entries"])

    flat = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in responses.schema)
    return responses.mapInArrow(run, f"{flat}, reason string, entries array<{_ENTRY}>")


def entry_rows(parsed: DataFrame) -> DataFrame:
    """Rows of parse_bodies to one row for each entry; see parse_feeds."""
    kept = [c for c in parsed.columns if c not in ("content", "reason", "entries")]
    exploded = parsed.withColumn("failed", F.col("reason").isNotNull()).select(*kept, "reason", "failed", F.posexplode_outer("entries").alias("pos", "e")).where("failed or e is not null")
    empty_title = F.when(F.col("e.title") == "", "(untitled)").otherwise(F.col("e.title"))
    return exploded.select(
        *kept, "reason", "pos",
        bounded(F.col("e.entry_key"), 500).alias("entry_key"), bounded(empty_title, 300).alias("title"), bounded(F.col("e.summary"), 2000).alias("summary"),
        F.when(~F.col("failed"), bounded(safe_article_url(F.col("e.link"), F.col("url")), 2048)).alias("article_url"), bounded(F.col("e.published"), 120).alias("published"),
    )


def parse_feeds(responses: DataFrame) -> DataFrame:
    """Fetched responses (with source_ord, name, url, max_entries, content) to one row for each entry.

    Columns: those of responses but content, then reason, pos, entry_key, title,
    summary, article_url, published. A body that is no feed gives one row with a
    reason and null entry columns; a feed without entries gives none.
    """
    return entry_rows(parse_bodies(responses))
