"""Enrichment: derived tags merged with curated ones, stamped only on change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom import schemas
from cardloom.functions.text import bounded_set, plain_text
from cardloom.operators.rules import PRODUCTS, TECHNIQUES, extract_cves, match_slugs, topic_slugs

TAGS = ("cves", "products", "techniques")


def derive(cards: DataFrame) -> DataFrame:
    """cards with derived: struct of cves, products, techniques, each sorted, distinct and cut to its limit.

    The text searched is the title, a newline, and the summary without HTML; the
    title is taken as it is. Null texts are empty.
    """
    rows = cards.withColumn("__plain", plain_text(F.coalesce("summary", F.lit(""))))

    def tags(h):
        found = {"cves": extract_cves(h["hay"]), "products": match_slugs(h["hay"], PRODUCTS), "techniques": F.array_union(match_slugs(h["hay"], TECHNIQUES), topic_slugs(h["plain"]))}
        return F.struct(*[bounded_set(found[t], schemas.LIST_LIMITS[t]).alias(t) for t in TAGS])

    # a lambda's argument is computed once, however many patterns read it
    texts = F.struct(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.col("__plain")).alias("hay"), F.col("__plain").alias("plain"))
    return rows.withColumn("derived", F.get(F.transform(F.array(texts), tags), 0)).drop("__plain")


def _same(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def enrich(cards: DataFrame, now: str) -> DataFrame:
    """Cards with merged tags, enrichment and changed.

    Curated tags are the card's tags without those of its prior enrichment; they
    are kept beside the newly derived ones. A card whose tags and enrichment
    stay the same keeps its stamp. Texts and digests are not touched.
    """
    none = F.array().cast("array<string>")
    if "enrichment" not in cards.columns:
        cards = cards.withColumn("enrichment", F.lit(None).cast(schemas.ENRICHMENT))
    rows = derive(cards)
    prior = {t: F.coalesce(F.col("enrichment")[t], none) for t in TAGS}
    own = {t: F.coalesce(F.col(t), none) for t in TAGS}
    merged = {t: bounded_set(F.array_union(F.array_except(own[t], prior[t]), F.col("derived")[t]), schemas.LIST_LIMITS[t]) for t in TAGS}
    same = F.coalesce(F.col("enrichment.version") == schemas.ENRICHMENT_VERSION, F.lit(False)) & F.col("enrichment.enriched_at").isNotNull()
    for t in TAGS:
        same = same & _same(merged[t], own[t]) & _same(F.col("derived")[t], prior[t])
    rows = rows.withColumns({"__same": same, **{f"__{t}": merged[t] for t in TAGS}})
    stamp = F.when(F.col("__same"), F.col("enrichment.enriched_at")).otherwise(F.lit(now))
    block = F.struct(F.lit(schemas.ENRICHMENT_VERSION).alias("version"), stamp.alias("enriched_at"), *[F.col("derived")[t].alias(t) for t in TAGS])
    rows = rows.withColumns({"enrichment": block, "changed": ~F.col("__same"), **{t: F.col(f"__{t}") for t in TAGS}})
    return rows.drop("derived", "__same", *[f"__{t}" for t in TAGS])


def enrich_summary(enriched: DataFrame) -> DataFrame:
    """One row: cards in all, changed, unchanged, and derived tags by kind."""
    return enriched.agg(
        F.count("*").alias("cards_total"), F.count_if("changed").alias("cards_changed"), F.count_if(~F.col("changed")).alias("cards_unchanged"),
        *[F.coalesce(F.sum(F.size(F.col("enrichment")[t])), F.lit(0)).alias(f"{t}_total") for t in TAGS],
    )
