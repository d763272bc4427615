"""Fail-closed validation of cards read as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom import schemas
from cardloom.functions.text import fingerprint
from cardloom.functions.times import is_timestamp
from cardloom.functions.urls import url_issues
from cardloom.sources.commits import shared_folder
from cardloom.sources.readers import classify_lines

# Patterns of ids, secrets, placeholders and injected prompts.
# They must equal the card format's; flags are written as Java has them.
ID = r"\A[a-z0-9][a-z0-9-]{2,83}-[0-9a-f]{12}\z"
SHA256 = r"\A[0-9a-f]{64}\z"
CVE = r"(?U)\ACVE-\d{4}-\d{4,}\z"
SECRETS = {
    "secret.private_key": r"(?sU)-----BEGIN [A-Z ]*PRIVATE KEY-----\s*(.*?)-----END [A-Z ]*PRIVATE KEY-----",
    "secret.bearer_token": r"(?iU)\bbearer\s+([A-Za-z0-9._~+/=-]{8,})",
    "secret.cookie": r"(?iU)\b(?:cookie|set-cookie)\s*:\s*([^;\n]+)",
    "secret.assignment": r"(?iU)\b(?:password|passwd|pwd|api[_-]?key|secret|access[_-]?token|refresh[_-]?token|session[_-]?id)\b\s*[:=]\s*['\"]?([^\s'\";,]+)",
}
PLACEHOLDER = r"\A(?:token|your_token|api_key|db_password|password|secret|changeme|dummy|placeholder)\z"
VARIABLE = r"\A\$?\{?[A-Z][A-Z0-9_]{2,}\}?\z"
_ASK = r"(?:(?:please|kindly|now)\s+|(?:can|could|would|will)\s+you\s+|you\s+(?:must|should|need\s+to)\s+)?"
INJECTIONS = (
    r"(?imdU)(?:^|[.!?]\s+)\s*" + _ASK + r"(?:ignore|disregard)\b[^\r\n.!?]{0,64}\b(?:(?:previous|prior)(?:\s+(?:system|developer|assistant))?|system)\s+instructions?\b",
    r"(?imdU)(?:^|[.!?]\s+)\s*(?:(?:this\s+is|i\s+am|i'm)\s+(?:an?\s+|the\s+)?(?:system|developer|assistant)\s+message\b|(?:system|developer|assistant)(?:\s+message)?\s*:\s*" + _ASK + r"(?:ignore|disregard|override|replace|follow|obey|execute|treat|act|respond|answer|reveal|exfiltrate|leak|print|return|provide|send|show)\b)",
    r"(?imdU)(?:^|[.!?]\s+)\s*" + _ASK + r"(?:reveal|exfiltrate|leak|print|return|provide|send|show)\b[^\r\n.!?]{0,64}\b(?:your|all|the|hidden|stored)\s+(?:(?:hidden|stored|initial|system|developer)\s+){0,2}(?:prompts?|instructions?|(?:api|access|auth(?:entication)?)?[-_ ]*tokens?|api[-_ ]*keys?|secrets?|credentials?)\b",
    r"(?iU)<\|(?:system|developer|assistant|user|im_start|im_end|start_header_id|end_header_id|eot_id)\|>|<</?sys>>|\[/?inst\]|</?(?:system|developer|assistant)>",
)
# End of fixed values.


def _strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", ""), r"\A['\"]+|['\"]+\z", "")


def is_placeholder(value: Column) -> Column:
    """Whether a value stands for a secret that is not there."""
    v = _strip(value)
    compact = F.lower(F.regexp_replace(F.regexp_replace(v, "[^a-z0-9]+", "_"), r"\A_+|_+\z", ""))
    low = F.lower(v)
    return low.contains("redacted") | low.contains("example.com") | compact.rlike(PLACEHOLDER) | v.rlike(VARIABLE)


def is_secret_value(value: Column) -> Column:
    v = _strip(value)
    return ~is_placeholder(v) & (F.length(v) >= 12) & v.rlike(r"(?U)\p{L}") & v.rlike(r"(?U)\p{Nd}")


#: A text without any of these holds no secret; one cheap look for most texts.
_HINT = r"(?iU)PRIVATE KEY|bearer|cookie|passw(?:or)?d|pwd|api[_-]?key|secret|token|session"


def _secrets_of(code: str, text: Column) -> Column:
    """Array of a text's secrets of a kind, as they stand there."""
    values = F.regexp_extract_all(text, F.lit(SECRETS[code]), F.lit(1))
    if code == "secret.private_key":
        body = lambda b: F.regexp_replace(b, r"(?U)\s+", "")
        return F.filter(values, lambda b: (F.length(body(b)) >= 40) & ~is_placeholder(body(b)))
    if code == "secret.cookie":
        values = F.transform(values, lambda b: F.regexp_replace(b, r"(?s)\A[^=]*=", ""))
    return F.filter(values, is_secret_value)


def secret_codes(text: Column) -> Column:
    """Array of codes, one for each secret in a text, in the order of SECRETS."""
    return F.flatten(F.array(*[F.array_repeat(F.lit(code), F.size(_secrets_of(code, text))) for code in SECRETS]))


#: Every injection pattern needs one of these; one cheap look for most texts.
_ASKED = r"(?iU)instruction|system|developer|assistant|prompt|token|key|secret|credential|<\||<<|\[/?inst"


def has_injection(text: Column) -> Column:
    hit = F.lit(False)
    for p in INJECTIONS:
        hit = hit | text.rlike(p)
    return F.coalesce(text.rlike(_ASKED) & hit, F.lit(False))


REDACTED = "[REDACTED]"


def redacted(text: Column) -> Column:
    """Text with each secret and each injected prompt replaced by a placeholder; other texts as they are, and none longer."""
    # a lambda's argument is computed once
    once = lambda c, f: F.get(F.transform(F.array(c), f), 0)

    def without(code):
        # the longest first, so that no secret leaves the rest of one that holds it
        def replaced(t):
            found = F.sort_array(F.transform(_secrets_of(code, t), lambda v: F.struct(F.length(v).alias("n"), v.alias("v"))), False)
            return F.aggregate(found, t, lambda acc, x: F.replace(acc, x["v"], F.lit(REDACTED)))

        return replaced

    hidden = text
    for code in SECRETS:
        hidden = once(hidden, without(code))
    *asked, marks = INJECTIONS

    def unasked(t):
        # a mark may be shorter than the placeholder
        clean = F.regexp_replace(t, marks, " ")
        for p in asked:
            clean = F.regexp_replace(clean, p, REDACTED)
        return F.when(has_injection(t), clean).otherwise(t)

    return once(F.when(text.rlike(_HINT), hidden).otherwise(text), unasked)


def sanitized(cards: DataFrame) -> DataFrame:
    """Cards with redacted titles and summaries; those that this changes are marked as sanitized."""
    new = cards.withColumns({f"__{c}": redacted(F.col(c)) for c in ("title", "summary")})
    same = F.col("title").eqNullSafe(F.col("__title")) & F.col("summary").eqNullSafe(F.col("__summary"))
    rows = new.withColumns({"safety": F.when(same, F.col("safety")).otherwise("sanitized"), "title": F.col("__title"), "summary": F.col("__summary")})
    return rows.select(*cards.columns)


#: Places that the checks read; each is taken out of a card once.
_PLACES = [f"$.{f}" for f in schemas.REQUIRED] + ["$.enrichment"] + [f"$.enrichment.{f}" for f in ("version", "enriched_at", *schemas.LIST_LIMITS)]


def opened(raw: DataFrame) -> DataFrame:
    """raw (line_no, v) with x: the fields, kinds and texts of a JSON object, null for other lines.

    x is an array with one struct for each place; the lambda's argument is
    computed once, so no check reads the JSON again. Lines are marked, not
    filtered: a filter would be pushed below what makes v, and compute it twice.
    """
    parts = F.array(*[F.try_variant_get("v", p, "variant") for p in _PLACES])
    x = F.transform(parts, lambda v: F.struct(F.schema_of_variant(v).alias("kind"), F.try_variant_get(v, "$", "string").alias("text"), v.alias("v")))
    return raw.withColumn("x", F.when(F.schema_of_variant("v").startswith("OBJECT"), x))


def _place(path: str) -> Column:
    return F.get("x", _PLACES.index(path))


def _at(path: str) -> Column:
    return _place(path)["v"]


def _type(path: str) -> Column:
    return _place(path)["kind"]


def _text(path: str) -> Column:
    return F.when(_type(path) == "STRING", _place(path)["text"])


def _list(path: str) -> Column:
    return F.when(_type(path).startswith("ARRAY"), F.try_variant_get(_at(path), "$", "array<variant>"))


def _issue(order: int, code: Column | str, location: Column | str, item: Column | int = 0) -> Column:
    as_col = lambda x: F.lit(x) if isinstance(x, str | int) else x
    return F.struct(F.lit(order).alias("check_ord"), as_col(item).cast("int").alias("item_ord"), as_col(code).alias("code"), as_col(location).alias("location"))


def _one(condition: Column, order: int, code, location) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.array(_issue(order, code, location)))


def _list_issues(path: str, limit: int, order: int, cve: bool) -> list[Column]:
    items = _list(path)
    out = [_one(_type(path).isNotNull() & items.isNull(), order, "invalid_type", path), _one(F.size(items) > limit, order, "list_too_long", path)]

    def check(v, i):
        text = F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
        unclean = (text == "") | text.rlike(r"(?U)\A[\s\x1c-\x1f]|[\s\x1c-\x1f]\z") | text.rlike(r"[\x00-\x1f]")
        code = F.when(text.isNull(), "invalid_type").when(unclean, "unclean_string")
        if cve:
            code = code.when(~text.rlike(CVE), "invalid_cve")
        return _issue(order, code, F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]")), i + 1)

    out.append(F.filter(F.transform(items, check), lambda s: s["code"].isNotNull()))
    return out


def field_checks() -> Column:
    """The issues of an opened card's fields as one array; null for other lines."""
    checks: list[Column] = [_one(_type(f"$.{f}").isNull(), 0, "missing_required", "$." + f) for f in schemas.REQUIRED]
    for f, limit in schemas.STRING_LIMITS.items():
        path, text = f"$.{f}", _text(f"$.{f}")
        code = F.when(text.isNull(), "invalid_type").when(text == "", "string_empty").when(F.length(text) > limit, "string_too_long")
        checks.append(_one(_type(path).isNotNull() & code.isNotNull(), 1, code, path))
    checks.append(_one(~_text("$.id").rlike(ID), 2, "invalid_id", "$.id"))
    checks += [_one(condition, 3, code, "$.source_url") for condition, code in url_issues(_text("$.source_url"))]
    checks += [_one(_text(f"$.{f}").isNotNull() & ~is_timestamp(_text(f"$.{f}")), 4, "invalid_timestamp", f"$.{f}") for f in ("published_at", "fetched_at")]
    checks.append(_one(~_text("$.content_sha256").rlike(SHA256), 5, "invalid_sha256", "$.content_sha256"))
    for f, limit in schemas.LIST_LIMITS.items():
        checks += _list_issues(f"$.{f}", limit, 6, f == "cves")
    for f, allowed in schemas.ENUMS.items():
        code = F.when(_text(f"$.{f}").isNull(), "invalid_type").when(~_text(f"$.{f}").isin(*allowed), "invalid_enum")
        checks.append(_one(_type(f"$.{f}").isNotNull() & code.isNotNull(), 7, code, f"$.{f}"))
    checks += [_one(has_injection(_text(f"$.{f}")), 8, "prompt_injection_pattern", f"$.{f}") for f in ("title", "summary")]
    checks += _enrichment_issues()
    return F.when(F.col("x").isNotNull(), F.flatten(F.array_compact(F.array(*checks))))


def card_issues(raw: DataFrame) -> DataFrame:
    """Issues of single cards: rows line_no, check_ord, item_ord, code, location.

    raw: line_no, v. Only lines that are JSON objects are looked at. Each check
    gives an array; they are joined and exploded once, so a clean card makes no row.
    """
    # an outer explode: for a plain one the optimiser would compute all checks twice, once to filter
    return opened(raw).select("line_no", F.explode_outer(field_checks()).alias("i")).where("i is not null").select("line_no", "i.*")


def _enrichment_issues() -> list[Column]:
    e = "$.enrichment"
    is_object = _type(e).startswith("OBJECT")
    out = [_one(_type(e).isNotNull() & ~is_object, 9, "invalid_type", e)]
    known = ("version", "enriched_at", "cves", "products", "techniques")
    extra = F.array_sort(F.array_except(F.json_object_keys(F.when(is_object, F.to_json(_at(e)))), F.array(*map(F.lit, known))))
    out.append(F.transform(extra, lambda k, i: _issue(10, "unexpected_field", F.concat(F.lit(e + "."), k), i)))
    version = _type(f"{e}.version")
    out.append(_one(is_object & (version.isNull() | (version != "BIGINT") | (F.try_variant_get(_at(f"{e}.version"), "$", "long") != schemas.ENRICHMENT_VERSION)), 11, "invalid_enrichment_version", f"{e}.version"))
    stamp = _text(f"{e}.enriched_at")
    out.append(_one(is_object & stamp.isNull(), 12, "invalid_type", f"{e}.enriched_at"))
    out.append(_one(is_object & stamp.isNotNull() & ~is_timestamp(stamp), 12, "invalid_timestamp", f"{e}.enriched_at"))
    for f in ("cves", "products", "techniques"):
        out.append(_one(is_object & _type(f"{e}.{f}").isNull(), 13, "missing_required", f"{e}.{f}"))
        out += _list_issues(f"{e}.{f}", schemas.LIST_LIMITS[f], 13, f == "cves")
    return out


def _depth(json: Column) -> Column:
    """How deep the brackets of a JSON text go."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(json, r"\\\\.", ""), '"[^"]*"', ""), r"[^\[\]{}]", "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc, c):
        now = acc["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(F.split(bare, ""), zero, step)["most"]


def every_string(v: Column) -> Column:
    """Array of (location, text) for each string of a variant, at any depth, in the order of its keys and items.

    In each round all objects and arrays give way to what they hold; there are as many rounds as the value is deep.
    """

    def held(s):
        at, kind = s["location"], F.schema_of_variant(s["v"])
        pairs = F.map_entries(F.try_variant_get(s["v"], "$", "map<string,variant>"))
        fields = F.transform(pairs, lambda e: F.struct(F.concat(at, F.lit("."), e["key"]).alias("location"), e["value"].alias("v")))
        items = F.transform(F.try_variant_get(s["v"], "$", "array<variant>"), lambda x, i: F.struct(F.concat(at, F.lit("["), i.cast("string"), F.lit("]")).alias("location"), x.alias("v")))
        return F.when(kind.startswith("OBJECT"), fields).when(kind.startswith("ARRAY"), items).otherwise(F.array(F.struct(at.alias("location"), s["v"].alias("v"))))

    start = F.array(F.struct(F.lit("$").alias("location"), v.alias("v")))
    depth = _depth(F.to_json(v))
    leaves = F.aggregate(F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>")), start, lambda acc, _: F.flatten(F.transform(acc, held)))
    strings = F.filter(leaves, lambda s: F.schema_of_variant(s["v"]) == "STRING")
    return F.transform(strings, lambda s: F.struct(s["location"].alias("location"), F.try_variant_get(s["v"], "$", "string").alias("text")))


def card_texts() -> Column:
    """Array of (location, text) of an opened card's strings; null for other lines.

    Cards with the format's keys and types are read by place; others are walked.
    """
    one = lambda path: F.array(F.struct(F.lit(path).alias("location"), _text(path).alias("text")))

    def many(path):
        items = F.coalesce(_list(path), F.array().cast("array<variant>"))
        return F.transform(items, lambda v, i: F.struct(F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]")).alias("location"), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).alias("text")))

    fields = [one(f"$.{f}") for f in (*schemas.STRING_LIMITS, *schemas.ENUMS)] + [many(f"$.{f}") for f in schemas.LIST_LIMITS]
    fields += [one("$.enrichment.enriched_at")] + [many(f"$.enrichment.{f}") for f in schemas.LIST_LIMITS]
    texts = F.filter(F.flatten(F.array(*fields)), lambda s: s["text"].isNotNull())
    keys = lambda path, known: F.size(F.array_except(F.json_object_keys(F.to_json(_at(path) if path else F.col("v"))), F.array(*map(F.lit, known)))) <= 0
    flat = lambda path: ~F.coalesce(_type(path).startswith("OBJECT") | _type(path).startswith("ARRAY"), F.lit(False))
    plain_list = lambda path: flat(path) | ~_type(path).rlike("OBJECT|ARRAY<(ARRAY|VARIANT)")
    plain = keys("", (*schemas.REQUIRED, "enrichment"))
    for f in (*schemas.STRING_LIMITS, *schemas.ENUMS):
        plain = plain & flat(f"$.{f}")
    e = "$.enrichment"
    for path in [f"$.{f}" for f in schemas.LIST_LIMITS] + [f"{e}.{f}" for f in schemas.LIST_LIMITS]:
        plain = plain & plain_list(path)
    block = _type(e).isNull() | (_type(e) == "VOID") | (_type(e).startswith("OBJECT") & keys(e, ("version", "enriched_at", *schemas.LIST_LIMITS)))
    plain = plain & block & flat(f"{e}.version") & flat(f"{e}.enriched_at")
    return F.when(F.col("x").isNotNull(), F.when(F.coalesce(plain, F.lit(False)), texts).otherwise(every_string(F.col("v"))))


def walk_text(raw: DataFrame) -> DataFrame:
    """Rows line_no, item_ord, location, text for every string at any depth of a card."""
    rows = opened(raw).select("line_no", F.posexplode_outer(card_texts()).alias("item_ord", "s"))
    return rows.where("s is not null").select("line_no", "item_ord", "s.*")


def secret_issues(texts: DataFrame) -> DataFrame:
    """Issues of the rows of walk_text: one for each secret."""
    codes = F.when(F.col("text").rlike(_HINT), secret_codes(F.col("text")))
    return texts.select("line_no", F.lit(14).alias("check_ord"), "item_ord", F.explode_outer(codes).alias("code"), "location").where("code is not null")


def _id_text() -> Column:
    one = F.try_variant_get("v", "$.id", "variant")
    is_text = F.schema_of_variant("v").startswith("OBJECT") & (F.schema_of_variant(one) == "STRING")
    return F.when(is_text, F.try_variant_get("v", "$.id", "string"))


def duplicate_issues(raw: DataFrame) -> DataFrame:
    """duplicate_id for every later line of an id, and conflicting_id_content where it differs from the first."""
    return repeated_ids(raw.select("line_no", _id_text().alias("id"), fingerprint(F.col("v")).alias("fp")))


def repeated_ids(lines: DataFrame) -> DataFrame:
    """The same from rows line_no, id, fp; lines without a text id don't count.

    Only id, line number and digest are shuffled. The first line of each id is
    found by an aggregate, so that many lines of one id need no single task.
    """
    rows = lines.where("id is not null").select("line_no", "id", "fp")
    first = rows.groupBy("id").agg(F.min("line_no").alias("first"), F.min_by("fp", "line_no").alias("first_fp"), F.count("*").alias("n")).where("n > 1")
    later = rows.join(first, "id").where("line_no > first")
    codes = F.array_compact(F.array(F.lit("duplicate_id"), F.when(F.col("fp") != F.col("first_fp"), "conflicting_id_content")))
    return later.select("line_no", F.lit(15).alias("check_ord"), F.posexplode(codes).alias("item_ord", "code")).withColumn("location", F.lit("$.id"))


def line_issues(raw: DataFrame) -> DataFrame:
    """Lines that hold no card; a blank line counts as malformed here."""
    kind = F.when(F.col("kind") == "blank_line", "malformed_jsonl").otherwise(F.col("kind"))
    return classify_lines(raw).where("kind <> 'card'").select("line_no", F.lit(-1).alias("check_ord"), F.lit(0).alias("item_ord"), kind.alias("code"), F.lit("$").alias("location"))


def relocate(issues: DataFrame) -> DataFrame:
    """Locations as `line N` and what follows the `$`."""
    return issues.withColumn("location", F.concat(F.lit("line "), F.col("line_no").cast("string"), F.expr("substring(location, 2)")))


def judged_lines(raw: DataFrame) -> DataFrame:
    """Rows line_no, kind, id, fp, source_name, issues: what one pass over the lines finds out about each.

    issues holds those of the line, its fields and its secrets, as one array.
    """
    kind = F.when(F.col("kind") == "blank_line", "malformed_jsonl").otherwise(F.col("kind"))
    line = F.when(F.col("kind") != "card", F.array(_issue(-1, kind, "$")))

    def secrets(s, i):
        codes = F.when(s["text"].rlike(_HINT), secret_codes(s["text"])).otherwise(F.array().cast("array<string>"))
        return F.transform(codes, lambda c: _issue(14, c, s["location"], i))

    found = F.flatten(F.transform(card_texts(), secrets))
    issues = F.flatten(F.array_compact(F.array(line, field_checks(), found)))
    return opened(classify_lines(raw)).select("line_no", "kind", _id_text().alias("id"), fingerprint(F.col("v")).alias("fp"), _text("$.source_name").alias("source_name"), issues.alias("issues"))


def validate_file(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(issues, report) of cards read by read_cards_raw.

    The lines are read and parsed once. What that finds, small beside the lines, is
    written to the shared folder; counts are observed on the way. Only ids and digests are
    shuffled, for duplicates, and the issues to put them in line and check order.
    """
    import uuid

    from pyspark.sql import Observation

    spark = raw.sparkSession
    at = f"{shared_folder(spark)}/validated-{uuid.uuid4().hex}"
    seen = Observation()
    lines = judged_lines(raw).observe(seen, F.count_if(F.col("kind") == "card").alias("cards"), F.sum(F.size("issues")).alias("issues"))
    lines.write.parquet(at)
    lines = spark.read.schema(lines.schema).parquet(at)
    again = repeated_ids(lines)
    cols = ["line_no", "check_ord", "item_ord", "code", "location"]
    own = lines.where(F.size("issues") > 0).select("line_no", F.explode("issues").alias("i")).select("line_no", "i.*").select(*cols)
    issues = relocate(own.union(again.select(*cols))).orderBy("line_no", "check_ord", "item_ord", "code")
    n = (seen.get["issues"] or 0) + again.count()
    return issues, spark.createDataFrame([(seen.get["cards"], n, n == 0, int(n > 0))], "card_count long, issue_count long, ok boolean, exit_code int")


def validate_cards(raw: DataFrame) -> DataFrame:
    """All issues of cards read by read_cards_raw, located by line, in line and check order."""
    return validate_file(raw)[0]


def report(issues: DataFrame, raw: DataFrame) -> DataFrame:
    """One row: cards (objects), issues, ok, exit_code."""
    cards = classify_lines(raw).agg(F.count_if(F.col("kind") == "card").alias("card_count"))
    n = issues.agg(F.count("*").alias("issue_count"))
    out = cards.crossJoin(n)  # one row each
    return out.withColumns({"ok": F.col("issue_count") == 0, "exit_code": F.when(F.col("issue_count") == 0, 0).otherwise(1)})


def issues_by_source(issues: DataFrame, raw: DataFrame) -> DataFrame:
    """Issues by the card's source_name (null where it is no text) and code."""
    name = F.try_variant_get("v", "$.source_name", "variant")
    named = raw.select("line_no", F.when(F.schema_of_variant(name) == "STRING", F.try_variant_get("v", "$.source_name", "string")).alias("source_name"))
    # one row for each card and code meets the cards
    each = issues.groupBy("line_no", "code").agg(F.count("*").alias("k"))
    return each.join(named, "line_no", "left").groupBy("source_name", "code").agg(F.sum("k").alias("n"))


def issues_by_code(issues: DataFrame) -> DataFrame:
    return issues.groupBy("code").agg(F.count("*").alias("n"))


def gate(issues: DataFrame) -> None:
    """Raises if there is any issue; reads no more than one."""
    first = issues.limit(1).collect()
    if first:
        raise ValueError(f"cards are not valid: {first[0]['code']} at {first[0]['location']}")
