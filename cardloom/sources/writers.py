"""Writers: canonical JSON lines, snapshots, state, releases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom import schemas
from cardloom.functions.text import ascii_json


def card_lines(cards: DataFrame):
    """A column of canonical JSON: sorted keys at both levels, no blanks, ASCII only; a null enrichment is left out."""
    cols = []
    for c in sorted(set(cards.columns) & {*schemas.names(schemas.ENRICHED)}):
        if c == "enrichment":
            e = F.col(c)
            inner = F.struct(*[e[k].alias(k) for k in ("cves", "enriched_at", "products", "techniques", "version")])
            cols.append(F.when(e.isNotNull(), inner).alias(c))
        else:
            cols.append(F.col(c))
    return ascii_json(F.to_json(F.struct(*cols)))


def write_cards_jsonl(cards: DataFrame, path: str, mode: str = "append") -> None:
    cards.select(card_lines(cards).alias("value")).write.mode(mode).text(path)


def write_snapshots(new: DataFrame, path: str) -> None:
    """Appends raw_sha256, content rows; give only those that new_snapshots() returns."""
    new.select("raw_sha256", "content").write.mode("append").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replaces a keyed table (state or health); df must not read the same path."""
    df.write.mode("overwrite").parquet(path)


write_state = write_health = write_table
