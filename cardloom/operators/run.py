"""The whole supply run, with a gate between its steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom import schemas
from cardloom.operators.collect import all_sources_failed
from cardloom.operators.enrich import enrich
from cardloom.operators.release import publish_release
from cardloom.operators.store import Store, collect_batch
from cardloom.sources.readers import classify_lines


def enrich_lines(raw: DataFrame, now: str) -> DataFrame:
    """enrich() for cards read by read_cards_raw, fail-closed: a line that is blank, no JSON or no object raises and names itself."""
    bad = classify_lines(raw).where("kind <> 'card'").select("line_no", "kind").orderBy("line_no").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['kind']} at line {bad[0]['line_no']}")
    cards = raw.select("line_no", F.from_json("line", schemas.ENRICHED).alias("c")).select("line_no", "c.*")
    return enrich(cards, now)


def supply(store: Store, batch: int, responses: DataFrame, sources: DataFrame, releases: str, now: str) -> DataFrame:
    """Collects a batch, tags all stored cards, validates and publishes them; returns the manifest.

    Where every source failed, nothing is published; where a card has an issue,
    publishing raises, and the last release stays. A batch that has been collected is not collected again,
    so a run that failed later can be repeated.
    """
    summary = collect_batch(store, batch, responses, sources)
    if all_sources_failed(summary):
        raise ValueError("every source failed")
    cards = store.table("cards").select(*schemas.names(schemas.CARD)).withColumn("enrichment", F.lit(None).cast(schemas.ENRICHMENT))
    return publish_release(enrich(cards, now).select(*schemas.names(schemas.ENRICHED)), releases, now)
