"""Collecting: response outcomes, new cards, state and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom import schemas
from cardloom.functions.text import bounded, card_id, content_sha256, first_non_empty
from cardloom.functions.times import published_at
from cardloom.functions.urls import is_public_url, redirect_reason
from cardloom.operators.feeds import entry_rows, parse_bodies


def request_plan(sources: DataFrame, state: DataFrame) -> DataFrame:
    """Sources with the conditional headers of their next request."""
    s = state.select("source_url", "etag", "last_modified")
    headers = F.map_filter(F.create_map(F.lit("If-None-Match"), "etag", F.lit("If-Modified-Since"), "last_modified"), lambda _, v: v.isNotNull() & (v != ""))
    return sources.join(s, sources["url"] == s["source_url"], "left").select(*sources.columns, headers.alias("headers"))


def classify_responses(responses: DataFrame, sources: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """Every source with its responses, and the first outcome that fits.

    Outcomes: unsupported_url, fetch_error (also for a source without a
    response), not_modified, http_NNN, response_too_large, malformed_xml (a
    DOCTYPE) or fetched; what parsing finds comes later, from parse_responses.
    redirect is the finer reason of an untrusted effective URL.

    Responses are judged before they meet the sources, and only fetched ones keep
    their content; URLs are tested once for each source. Up to broadcast_rows
    sources are sent to the responses, whose bodies stay where they are; sources
    without a response are found by their URLs alone.
    """
    reason = redirect_reason(F.col("source_url"), F.coalesce("effective_url", "source_url"))
    body = F.lower(F.decode("content", "ISO-8859-1"))
    outcome = (
        F.when(F.col("error").isNotNull() | F.col("status_code").isNull() | F.col("redirect").isNotNull(), "fetch_error")
        .when(F.col("status_code") == 304, "not_modified")
        .when(~F.col("status_code").between(200, 299), F.concat(F.lit("http_"), F.col("status_code").cast("string")))
        .when(F.length("content") > schemas.MAX_BYTES, "response_too_large")
        .when(F.locate("<!doctype", body) > 0, "malformed_xml")
        .otherwise("fetched")
    )
    judged = responses.withColumn("redirect", reason).withColumn("outcome", outcome)
    judged = judged.withColumn("content", F.when(F.col("outcome") == "fetched", F.coalesce("content", F.lit(b""))))
    known = sources.withColumn("__public", is_public_url(F.col("url")))
    few = sources.limit(broadcast_rows + 1).count() <= broadcast_rows
    answered = judged.join(F.broadcast(known) if few else known, known["url"] == judged["source_url"])
    silent = known.join(responses.select(F.col("source_url").alias("url")).distinct(), "url", "left_anti")
    r = answered.unionByName(silent, allowMissingColumns=True).select(*known.columns, *judged.columns)
    final = F.when(~F.col("__public"), "unsupported_url").otherwise(F.coalesce("outcome", F.lit("fetch_error")))
    r = r.withColumns({"outcome": final, "source_url": F.col("url")})
    return r.withColumn("content", F.when(F.col("outcome") == "fetched", F.col("content"))).drop("__public")


def parse_responses(classified: DataFrame) -> DataFrame:
    """Rows of classify_responses with entries; a body that is no feed turns its outcome into the reason and loses its content."""
    parsed = parse_bodies(classified)
    failed = F.col("reason").isNotNull()
    return parsed.withColumns({"outcome": F.coalesce("reason", "outcome"), "content": F.when(~failed, F.col("content")), "entries": F.when(~failed, F.col("entries"))}).drop("reason")


def entries_of_batch(parsed: DataFrame) -> DataFrame:
    """Entries (the input of build_cards) of the rows of parse_responses."""
    return entry_rows(parsed.select("source_ord", "name", "url", "fetched_at", "entries", F.lit(None).cast("string").alias("reason")))


def build_cards(entries: DataFrame) -> DataFrame:
    """Entries (url, name, source_ord, pos, fetched_at and the columns of parse_feeds) to cards, with source_ord and pos."""
    title = bounded(F.col("title"), 140)
    rows = entries.where("reason is null").select(
        "source_ord", "pos", "url", "name", "fetched_at", "entry_key", "article_url", title.alias("title"),
        first_non_empty(bounded(F.col("summary"), 1000), title).alias("summary"), published_at(F.col("published"), F.col("fetched_at")).alias("published_at"),
    )
    c = F.col
    digest = content_sha256(entry_key=c("entry_key"), published_at=c("published_at"), source_name=c("name"), source_url=c("article_url"), summary=c("summary"), title=c("title"))
    none = F.array().cast("array<string>")
    return rows.select(
        card_id(c("url"), c("entry_key")).alias("id"), "title", "summary", c("article_url").alias("source_url"), c("name").alias("source_name"), "published_at", "fetched_at",
        digest.alias("content_sha256"), none.alias("products"), none.alias("cves"), none.alias("techniques"), F.lit("medium").alias("confidence"), F.lit("public").alias("safety"), "source_ord", "pos",
    )


def first_of_batch(parsed: DataFrame) -> DataFrame:
    """One card for each id: the first by source and place. An aggregate, so copies meet before the shuffle."""
    rest = [c for c in parsed.columns if c != "id"]
    first = parsed.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct("source_ord", "pos")).alias("r"))
    return first.select("id", "r.*")


def new_cards(parsed: DataFrame, store: DataFrame) -> DataFrame:
    """The batch's first cards whose id the store does not hold."""
    return first_of_batch(parsed).join(store.select("id"), "id", "left_anti")


def append_cards(store: DataFrame, new: DataFrame) -> DataFrame:
    """Stored cards, unchanged, and the new ones."""
    return store.unionByName(new.select(*store.columns))


def changed_entries(parsed: DataFrame, store: DataFrame) -> DataFrame:
    """Known ids whose content differs from the stored card's: a drift report; the store keeps the first version."""
    known = store.select("id", F.col("content_sha256").alias("stored_sha256"))
    return first_of_batch(parsed).join(known, "id").where("content_sha256 <> stored_sha256").select("id", "stored_sha256", "content_sha256")


def new_snapshots(responses: DataFrame, store: DataFrame) -> DataFrame:
    """raw_sha256, content of bodies that parsed and are not in the store; only hashes are compared, bodies follow."""
    hashed = responses.where("outcome = 'fetched'").withColumn("raw_sha256", F.sha2("content", 256))
    new = hashed.select("raw_sha256").distinct().join(store.select("raw_sha256"), "raw_sha256", "left_anti")
    # any row's body will do: the least source and address, found without the bodies
    chosen = hashed.groupBy("raw_sha256").agg(F.min(F.struct("source_ord", "source_url")).alias("c")).join(new, "raw_sha256").select("raw_sha256", "c.*")
    return hashed.join(chosen, ["raw_sha256", "source_ord", "source_url"], "left_semi").select("raw_sha256", "content").dropDuplicates(["raw_sha256"])


def fetched_state(responses: DataFrame) -> DataFrame:
    """State rows of successful fetches; of a source listed twice the last counts."""
    h = F.transform_keys("headers", lambda k, _: F.lower(k))
    rows = responses.where("outcome = 'fetched'").select("source_ord", "source_url", F.coalesce(h["etag"], F.lit("")).alias("etag"), F.coalesce(h["last-modified"], F.lit("")).alias("last_modified"), F.sha2("content", 256).alias("raw_sha256"), F.col("fetched_at").alias("last_fetched_at"))
    last = rows.groupBy("source_url").agg(F.max_by(F.struct("etag", "last_modified", "raw_sha256", "last_fetched_at"), "source_ord").alias("r"))
    return last.select("source_url", "r.*")


def upsert_state(state: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetched rows replace those of the same source as a whole; the others stay."""
    cols = ["etag", "last_modified", "raw_sha256", "last_fetched_at"]
    a = state.select("source_url", F.struct(*cols).alias("old"))
    b = fetched.select("source_url", F.struct(*cols).alias("new"))
    return a.join(b, "source_url", "full_outer").select("source_url", F.coalesce("new", "old").alias("r")).select("source_url", "r.*")


def collection_summary(outcomes: DataFrame, parsed: DataFrame, new: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row of counts; skipped are cards known before or repeated in the batch."""
    counts = outcomes.agg(
        F.count("*").alias("sources_total"), F.count_if(F.col("outcome") == "fetched").alias("sources_fetched"),
        F.count_if(F.col("outcome") == "not_modified").alias("sources_not_modified"),
        F.count_if(~F.col("outcome").isin("fetched", "not_modified")).alias("sources_failed"),
    )
    n = lambda df, name: df.agg(F.count("*").alias(name))
    out = counts.crossJoin(n(new, "cards_added")).crossJoin(n(parsed, "parsed")).crossJoin(n(snapshots, "snapshots_added"))  # one row each
    return out.withColumn("cards_skipped", F.col("parsed") - F.col("cards_added")).drop("parsed")


def failures(outcomes: DataFrame) -> DataFrame:
    """Failed sources in source order."""
    return outcomes.where(~F.col("outcome").isin("fetched", "not_modified")).select("source_ord", F.col("name").alias("source_name"), "source_url", F.col("outcome").alias("reason")).orderBy("source_ord")


def all_sources_failed(summary: DataFrame) -> bool:
    """The gate of a run: whether there were sources and every one failed."""
    return not summary.where("sources_total > 0 and sources_failed = sources_total").isEmpty()
