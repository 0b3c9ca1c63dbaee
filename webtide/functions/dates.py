"""Dates found in sitemaps and HTTP headers. Text without an offset means UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtide.functions.text import strip

_ISO = (
    r"\A([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"
    r"(?:(T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})(?:(Z)|([+-][0-9]{2}):?([0-9]{2}))?)?\z"
)

# Seconds per sitemap change frequency.
CHANGEFREQ_SECONDS = {
    "always": 0,
    "hourly": 3600,
    "daily": 86400,
    "weekly": 604800,
    "monthly": 2592000,
    "yearly": 31536000,
}

# RFC 2822 zone names.
ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "AST": "-0400", "ADT": "-0300",
    "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600",
    "PST": "-0800", "PDT": "-0700",
}

_TIME = r"([0-9]{1,2}:[0-9]{1,2})(:[0-9]{1,2})?"
_RFC = (
    r"\A(?:[A-Za-z]+,?\s*)?([0-9]{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*[\s-]+([0-9]{4}|[0-9]{2})\s+"
    + _TIME
    + r"(?:\s+([+-][0-9]{4}|[A-Za-z]+))?"
)
_ASC = r"\A[A-Za-z]+\s+([A-Za-z]{3})[A-Za-z]*\s+([0-9]{1,2})\s+" + _TIME + r"\s+([0-9]{4})"


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def parse_iso(c: Column) -> Column:
    """Day, or day and time, with or without an offset; anything else is NULL."""
    s = strip(c)
    part = lambda k: F.regexp_extract(s, _ISO, k)
    time = F.when(part(2) == "", F.lit("T0:0:0")).otherwise(part(2))
    zone = F.when(part(4) == "", F.lit("+00:00")).otherwise(F.concat(part(4), F.lit(":"), part(5)))
    full = F.concat(part(1), time, zone)
    return F.when(
        s.rlike(_ISO), F.try_to_timestamp(full, F.lit("yyyy-M-d'T'H:m:sXXX"))
    )


def parse_http_date(c: Column) -> Column:
    """RFC 2822, RFC 850 and asctime dates; NULL when none of them fits."""
    s = strip(c)
    rfc = lambda k: F.regexp_extract(s, _RFC, k)
    asc = lambda k: F.regexp_extract(s, _ASC, k)
    zone_text = rfc(6)
    zone = F.when(zone_text.rlike("^[+-]"), zone_text).otherwise(
        F.coalesce(F.try_element_at(_literal_map(ZONES), F.upper(zone_text)), F.lit("+0000"))
    )
    short = F.length(rfc(3)) == 2
    year = F.when(
        short, F.concat(F.when(rfc(3) > "68", F.lit("19")).otherwise(F.lit("20")), rfc(3))
    ).otherwise(rfc(3))
    seconds = lambda x: F.when(x == "", F.lit(":0")).otherwise(x)
    fields = F.when(
        s.rlike(_RFC),
        F.concat_ws(" ", rfc(1), rfc(2), year, F.concat(rfc(4), seconds(rfc(5))), zone),
    ).when(
        s.rlike(_ASC),
        F.concat_ws(" ", asc(2), asc(1), asc(5), F.concat(asc(3), seconds(asc(4))), F.lit("+0000")),
    )
    return F.try_to_timestamp(fields, F.lit("d MMM yyyy H:m:s XX"))


def changefreq_seconds(c: Column) -> Column:
    return F.try_element_at(_literal_map(CHANGEFREQ_SECONDS), F.lower(c))
