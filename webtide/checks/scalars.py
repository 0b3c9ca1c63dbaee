"""URL, date and hash functions over every spelling of every page address."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.registry import SPACE, check, sql_strip
from webtide.functions import dates, text, urls
from webtide.functions.outcome import is_permanent

_NONSPACE = SPACE.replace("[", "[^", 1)
_HOST = rf"([A-Za-z0-9-]+\.)+[A-Za-z]{{2,}}(/{_NONSPACE}*)?$"
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def sql_part(x: str, k: int) -> str:
    return f"regexp_extract(regexp_replace({x}, '^[\\x00-\\x20]+', ''), '{_PARTS}', {k})"


def sql_path(x: str) -> str:
    return f"regexp_replace({sql_part(x, 3)}, ';[^/]*$', '')"


def sql_domain(x: str) -> str:
    low = f"lower({sql_strip(x)})"
    return (
        f"regexp_replace(CASE WHEN {low} LIKE 'http://%' OR {low} LIKE 'https://%' "
        f"THEN regexp_extract({low}, '^https?://([^/?#]*)', 1) ELSE {low} END, '^www\\.', '')"
    )


def sql_valid(x: str) -> str:
    s = sql_strip(x)
    return (
        f"CASE WHEN regexp_matches({s}, '^https?://') THEN regexp_matches({s}, '^https?://{_HOST}') "
        f"ELSE regexp_matches({s}, '^{_HOST}') END"
    )


def sql_protocol(x: str) -> str:
    s = sql_strip(x)
    return f"CASE WHEN regexp_matches({s}, '^https?://') THEN {s} ELSE 'https://' || {s} END"


def sql_clean(x: str) -> str:
    return f"split_part(rtrim({sql_strip(x)}, '/'), '#', 1)"


_ALL = "SELECT i, k, {} FROM fx_urls"


@check("u1_clean_url", _ALL.format(f"{sql_clean('u')} AS cleaned"))
def _(x):
    return x.fx_urls.select("i", "k", urls.clean_url(F.col("u")).alias("cleaned"))


@check("u2_with_protocol", _ALL.format(f"{sql_protocol('u')} AS full_url"))
def _(x):
    return x.fx_urls.select("i", "k", urls.with_protocol(F.col("u")).alias("full_url"))


@check("u3_normalize_domain", _ALL.format(f"{sql_domain('u')} AS domain"))
def _(x):
    return x.fx_urls.select("i", "k", urls.normalize_domain(F.col("u")).alias("domain"))


@check("u4_validate_url", _ALL.format(f"{sql_valid('u')} AS valid"))
def _(x):
    return x.fx_urls.select("i", "k", urls.validate_url(F.col("u")).alias("valid"))


@check(
    "u5_url_split",
    _ALL.format(
        f"lower({sql_part('u', 1)}) AS scheme, {sql_part('u', 2)} AS netloc, "
        f"CASE WHEN lower({sql_part('u', 1)}) IN ('', 'http', 'https') THEN {sql_path('u')} "
        f"ELSE {sql_part('u', 3)} END AS path, {sql_part('u', 4)} AS query"
    ),
)
def _(x):
    return x.fx_urls.select("i", "k", urls.url_struct(F.col("u")).alias("s")).select("i", "k", "s.*")


def sql_resolve(base: str, href: str) -> str:
    """Relative resolution for DuckDB: dots are folded with list_reduce over wrapped lists."""
    part = sql_part
    path = part(href, 3)
    base_dir = f"regexp_replace({sql_path(base)}, '[^/]*$', '')"
    merged = (
        f"CASE WHEN {path} LIKE '/%' THEN string_split({path}, '/') ELSE "
        f"list_concat(CASE WHEN {base_dir} = '' THEN [''] ELSE string_split({base_dir}, '/')[:-2] END, "
        f"list_concat(list_filter(string_split({path}, '/')[:-2], lambda s: s <> ''), "
        f"string_split({path}, '/')[-1:])) END"
    )
    fold = (
        f"list_reduce(list_concat([CAST([] AS VARCHAR[])], list_transform({merged}, lambda s: [s])), "
        "lambda a, s: CASE WHEN s[1] = '..' THEN a[:-2] WHEN s[1] = '.' THEN a ELSE list_concat(a, s) END)"
    )
    dots = f"(regexp_matches({path}, '(^|/)[.][.]?$'))"
    folded = f"array_to_string({fold}, '/') || CASE WHEN {dots} THEN '/' ELSE '' END"
    whole = f"'/' || ltrim({folded}, '/')"
    rooted = f"CASE WHEN {path} LIKE '/%' AND NOT contains({path}, '/.') THEN {path} ELSE {whole} END"
    origin = f"{part(base, 1)} || '://' || {part(base, 2)}"
    tail = f"CASE WHEN {part(href, 4)} <> '' THEN '?' || {part(href, 4)} ELSE '' END"
    return f"""CASE WHEN regexp_matches({href}, '^https?://') THEN {href}
        WHEN {part(href, 1)} <> '' THEN CASE WHEN lower({part(href, 1)}) = lower({part(base, 1)})
             THEN lower({part(href, 1)}) || substr({href}, length({part(href, 1)}) + 1) ELSE {href} END
        WHEN {part(href, 2)} <> '' THEN {part(base, 1)} || ':' || {href}
        WHEN {path} = '' THEN {origin} || {part(base, 3)} || {tail}
        ELSE {origin} || ({rooted}) || {tail} END"""


_HREFS = """
  SELECT i, url, h, CASE h
      WHEN 1 THEN '../x' || si || '/./y' WHEN 2 THEN '/' || lang || '//' || si WHEN 3 THEN '?page=' || si
      WHEN 4 THEN '//cdn.' || auth || '/a' WHEN 5 THEN 'mailto:x@' || auth WHEN 6 THEN raw_url
      WHEN 7 THEN '../../../../c' || si WHEN 8 THEN '..' WHEN 9 THEN 'x//y/../z?q=1'
      WHEN 10 THEN './' WHEN 11 THEN 'HTTP://' || auth || '/X' ELSE 'a/' END AS href
  FROM (SELECT i, url, raw_url, auth, lang, CAST(i AS STRING) AS si,
               {unnest} FROM p) q"""
_DUCK_HREFS = _HREFS.format(unnest="unnest(range(1, 13)) AS h")


@check(
    "u6_resolve_href",
    f"WITH hr AS ({_DUCK_HREFS}) SELECT i, CAST(h AS INT) AS h, {sql_resolve('url', 'href')} AS resolved FROM hr",
)
def _(x):
    rows = x.sql(_HREFS.format(unnest="explode(sequence(1, 12)) AS h"))
    return rows.select("i", "h", urls.resolve(F.col("url"), F.col("href")).alias("resolved"))


@check(
    "u7_extension_list",
    f"""SELECT i, list_transform(list_filter(list_transform(
          string_split('.jpg, ' || lang || ' ,,.' || CAST(i AS STRING) || ', PNG', ','),
          lambda e: {sql_strip('e')}), lambda e: e <> ''),
          lambda e: CASE WHEN e LIKE '.%' THEN e ELSE '.' || e END) AS items FROM p""".replace(
        "list_transform(list_filter", "array_to_string(list_transform(list_filter", 1
    ).replace("END) AS items", "END), '|') AS items"),
)
def _(x):
    raw = F.concat(
        F.lit(".jpg, "), F.col("lang"), F.lit(" ,,."), F.col("i").cast("string"), F.lit(", PNG")
    )
    return x.p.select("i", F.array_join(urls.extension_list(raw), "|").alias("items"))


@check("u8_content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM docs")
def _(x):
    return x.docs.select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


_ISO = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(?:T([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})(?:Z|([+-])([0-9]{2}):?([0-9]{2}))?)?$"


def sql_iso_epoch(x: str) -> str:
    s = f"trim({x})"
    g = lambda k: f"regexp_extract({s}, '{_ISO}', {k})"
    stamp = (
        f"{g(1)} || '-' || lpad({g(2)}, 2, '0') || '-' || lpad({g(3)}, 2, '0') || ' ' || "
        f"CASE WHEN {g(4)} = '' THEN '00:00:00' ELSE {g(4)} END"
    )
    shift = (
        f"CASE WHEN {g(5)} = '' THEN 0 ELSE (CASE WHEN {g(5)} = '-' THEN -1 ELSE 1 END) * "
        f"(CAST({g(6)} AS BIGINT) * 3600 + CAST({g(7)} AS BIGINT) * 60) END"
    )
    return (
        f"CASE WHEN regexp_matches({s}, '{_ISO}') THEN "
        f"CAST(epoch(TRY_CAST({stamp} AS TIMESTAMP)) AS BIGINT) - ({shift}) END"
    )


@check(
    "u9_parse_iso_date",
    f"SELECT i, coalesce({sql_iso_epoch('lastmod')}, -1) AS lastmod_s FROM pm",
)
def _(x):
    stamp = F.unix_seconds(dates.parse_iso(F.col("lastmod")))
    return x.pm.select("i", F.coalesce(stamp, F.lit(-1).cast("bigint")).alias("lastmod_s"))


def sql_http_epoch(x: str) -> str:
    return f"CAST(epoch(TRY_STRPTIME({x}, '%a, %d %b %Y %H:%M:%S GMT')) AS BIGINT)"


@check(
    "u10_parse_http_date",
    f"SELECT i, coalesce({sql_http_epoch('last_modified')}, -1) AS modified_s FROM fx_captures",
)
def _(x):
    stamp = F.unix_seconds(dates.parse_http_date(F.col("last_modified")))
    return x.fx_captures.select("i", F.coalesce(stamp, F.lit(-1).cast("bigint")).alias("modified_s"))


SQL_FREQ = """CASE lower({}) WHEN 'always' THEN 0 WHEN 'hourly' THEN 3600 WHEN 'daily' THEN 86400
  WHEN 'weekly' THEN 604800 WHEN 'monthly' THEN 2592000 WHEN 'yearly' THEN 31536000 END"""


@check(
    "u11_changefreq_seconds",
    f"SELECT i, freq, CAST(coalesce({SQL_FREQ.format('freq')}, -1) AS INT) AS seconds FROM pm",
)
def _(x):
    return x.pm.select(
        "i", "freq", F.coalesce(dates.changefreq_seconds(F.col("freq")), F.lit(-1)).alias("seconds")
    )


@check(
    "u13_permanent_error",
    """SELECT attempt_id, coalesce(regexp_matches(lower(error),
         '404|not found|403|forbidden|400|bad request|not supported'), false) AS permanent FROM fx_attempts""",
)
def _(x):
    return x.fx_attempts.select(
        "attempt_id", F.coalesce(is_permanent(F.col("error")), F.lit(False)).alias("permanent")
    )


SQL_EMPTY = f"""(body IS NULL OR length({sql_strip('body')}) < 100
  OR contains(lower(body), '<title>access denied</title>')
  OR (contains(lower(body), 'captcha') AND length(body) < 3000))"""


@check("u14_empty_content", f"SELECT i, {SQL_EMPTY} AS empty FROM fx_captures")
def _(x):
    return x.fx_captures.select("i", text.is_empty_content(F.col("body")).alias("empty"))
