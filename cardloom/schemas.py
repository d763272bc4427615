"""Schemas, limits and other fixed values of the card model."""

CARD = (
    "id string, title string, summary string, source_url string, source_name string, published_at string, fetched_at string, content_sha256 string, "
    "products array<string>, cves array<string>, techniques array<string>, confidence string, safety string"
)
ENRICHMENT = "struct<version: int, enriched_at: string, cves: array<string>, products: array<string>, techniques: array<string>>"
ENRICHED = f"{CARD}, enrichment {ENRICHMENT}"
SOURCES = "source_ord int, name string, url string, max_entries int"
RESPONSES = "run_id long, source_url string, effective_url string, status_code int, headers map<string,string>, content binary, error string, fetched_at string"
ENTRIES = "entry_key string, title string, summary string, source_url string, published_at string"
STATE = "source_url string, etag string, last_modified string, raw_sha256 string, last_fetched_at string"
FAILURES = "source_name string, source_url string, reason string"
HEALTH = "source_url string, source_name string, consecutive_failures int, first_failed_at string, last_reason string"
ISSUES = "line_no long, check_ord int, item_ord int, code string, location string"

# They must equal the card format's for right results.
STRING_LIMITS = {"id": 128, "title": 140, "summary": 1000, "source_url": 2048, "source_name": 120, "published_at": 40, "fetched_at": 40, "content_sha256": 64}
LIST_LIMITS = {"products": 20, "cves": 50, "techniques": 30}
ENUMS = {"confidence": ("low", "medium", "high"), "safety": ("public", "sanitized")}
REQUIRED = (*STRING_LIMITS, *LIST_LIMITS, *ENUMS)
MAX_BYTES, MAX_ENTRIES, DEFAULT_THRESHOLD = 1_048_576, 50, 3
COMPATIBILITY, SCHEMA_VERSION, ENRICHMENT_VERSION = "cardloom-v1", 1, 1
LOCAL_SUFFIXES = ("home", "home.arpa", "internal", "lan", "local", "localdomain", "localhost")


def names(schema: str) -> list[str]:
    """Column names of a flat DDL string."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).names
