"""Timestamps kept as ISO-8601 text in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Calendar dates and week dates, times down to the hour, and offsets down to the second; each with or without marks.
ISO = (
    r"\A(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d)|(\d{4})-?W(\d\d)(?:-?([1-7]))?)"
    r"T(\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,]\d+)?)?)?(?:Z|[+-](\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,]\d+)?)?)?)\z"
)
#: The usual form of feeds: a weekday or none, and GMT.
GMT = r"\A(?:[A-Za-z]{3}, )?(\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d{4} \d\d:\d\d:\d\d) (?:GMT|UTC|\+0000)\z"


@F.pandas_udf(T.StringType())
def _utc_text(values):
    """ISO-8601 or RFC-2822 text with a zone, as UTC text; null where it is neither."""
    import datetime as dt
    from email.utils import parsedate_to_datetime

    def one(value):
        if not value:
            return None
        for parse in (lambda v: dt.datetime.fromisoformat(v.replace("Z", "+00:00")), parsedate_to_datetime):
            try:
                stamp = parse(value)
            except (TypeError, ValueError):
                continue
            try:
                return None if stamp.utcoffset() is None else stamp.astimezone(dt.UTC).isoformat().replace("+00:00", "Z")
            except OverflowError:
                return None
        return None

    return values.map(one, na_action="ignore")


def _gmt_text(raw: Column) -> Column:
    """UTC text of the usual form of feeds, without Python; null for any other."""
    at = F.try_to_timestamp(F.concat(F.regexp_extract(raw, GMT, 1), F.lit(" +0000")), F.lit("d MMM yyyy HH:mm:ss Z"))
    whole = (F.unix_seconds(at).cast("long")).cast("timestamp")
    return F.when(raw.rlike(GMT), F.date_format(F.to_utc_timestamp(whole, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def published_at(raw: Column, fetched_at: Column) -> Column:
    """The publication time in UTC, or fetched_at where it can't be read or has no zone. Python sees only uncommon forms."""
    native = _gmt_text(raw)
    return F.coalesce(native, _utc_text(F.when(native.isNull(), raw)), fetched_at)


def is_timestamp(c: Column) -> Column:
    """Whether text is an ISO-8601 time with T and a zone."""
    group = lambda i: F.regexp_extract(c, ISO, i).try_cast("int")
    year, month, day = (F.coalesce(group(i), group(i + 3)) for i in (1, 2, 3))
    below = lambda i, n: F.coalesce(group(i), F.lit(0)) < n
    date = F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd").isNotNull() & (year > 0)
    # a year's last week is that of 28 December
    week = F.coalesce(group(8).between(1, F.weekofyear(F.make_date(group(7), F.lit(12), F.lit(28)))), F.lit(False)) & (group(7) > 0)
    clock = below(10, 24) & below(11, 60) & below(12, 60) & below(13, 24) & below(14, 60) & below(15, 60)
    return F.coalesce(c.rlike(ISO) & clock & F.when(group(7).isNull(), date).otherwise(week), F.lit(False))
