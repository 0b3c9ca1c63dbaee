"""robots.txt: directive lines, delays, hints and the allow/deny test.

All windows run over the lines of one file, which came out of one row; the whole chain stays hash-partitioned
by domain, so splitting a file into lines costs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtide.functions import urls
from webtide.functions.text import SPACE, SPACE_CHARS, strip
from webtide.plans.once import computed

_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
_REFRESH = rf"\A#{SPACE}*refresh:{SPACE}*([^{SPACE_CHARS}]+){SPACE}+(\p{{Nd}}+)"
_NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def _by_line() -> Window:
    return Window.partitionBy("domain").orderBy("line_no")


def _value(line: Column) -> Column:
    """What follows the first colon, stripped."""
    return strip(F.substr(line, F.locate(":", line) + 1))


def _has(name: str) -> Column:
    return F.startswith(F.lower("line"), F.lit(f"{name}:"))


def directive_lines(files: DataFrame) -> DataFrame:
    """(domain, line_no, raw, line): every line of every file, with and without outer blanks."""
    parts = F.split("text", _LINE_END, -1)
    # text that ends in a line end has no further, empty line
    whole = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return files.select("domain", F.posexplode(whole).alias("line_no", "raw")).withColumn(
        "line", strip(F.col("raw"))
    )


def crawl_delays(lines: DataFrame, user_agent: str) -> DataFrame:
    """(domain, crawl_delay): the last value of a block naming this agent, else the last of a '*' block."""
    agent = F.lower(_value(F.col("line")))
    significant = lines.filter((F.col("line") != "") & ~F.startswith("line", F.lit("#")))
    marked = significant.select(
        "domain",
        "line_no",
        _has("user-agent").alias("is_ua"),
        F.when(_has("user-agent"), agent).alias("agent"),
        F.when(_has("crawl-delay"), _value(F.col("line"))).alias("delay_text"),
    )
    starts = F.col("is_ua") & ~F.coalesce(F.lag("is_ua").over(_by_line()), F.lit(False))
    blocks = marked.withColumn("starts", starts.cast("int")).withColumn(
        "block", F.sum("starts").over(_by_line())
    )
    whole = Window.partitionBy("domain", "block")
    mine = F.contains(F.lit(user_agent.lower()), F.col("agent"))
    flagged = blocks.withColumn(
        "wild", F.coalesce(F.bool_or(F.col("agent") == "*").over(whole), F.lit(False))
    ).withColumn("named", F.coalesce(F.bool_or(mine).over(whole), F.lit(False)))
    delay = F.when(F.col("delay_text").rlike(_NUMBER), F.col("delay_text").try_cast("double"))
    rows = flagged.withColumn("delay", delay).filter(F.col("delay").isNotNull())
    last = lambda cond: F.max_by(F.when(cond, F.col("delay")), F.when(cond, F.col("line_no")))
    return rows.groupBy("domain").agg(
        F.coalesce(last(F.col("named") & ~F.col("wild")), last(F.col("wild"))).alias("crawl_delay")
    )


def sitemap_lines(lines: DataFrame) -> DataFrame:
    """(domain, line_no, sitemap): declared sitemaps, wherever they stand."""
    return (
        lines.filter(_has("sitemap"))
        .select("domain", "line_no", _value(F.col("line")).alias("sitemap"))
        .filter(F.col("sitemap") != "")
    )


def refresh_hints(lines: DataFrame) -> DataFrame:
    """(domain, prefix, interval_s): '# refresh: prefix seconds', the last one per prefix."""
    hit = lambda k: F.regexp_extract("line", _REFRESH, k)
    return (
        lines.filter(F.col("line").rlike(_REFRESH))
        .select("domain", "line_no", hit(1).alias("prefix"), hit(2).try_cast("bigint").alias("interval_s"))
        .groupBy("domain", "prefix")
        .agg(F.max_by("interval_s", "line_no").alias("interval_s"))
    )


def rule_tables(lines: DataFrame, user_agent: str) -> DataFrame:
    """(domain, rules): the rules that apply to this agent, in file order, as an array.

    Entries follow the standard reader: one or more agent lines, then rule lines; an exactly empty line
    ends an entry; named entries go before the first '*' entry.
    """
    bare = strip(F.split_part("raw", F.lit("#"), F.lit(1)))
    colon = F.locate(":", bare)
    name = F.when(colon > 0, F.lower(strip(F.substr(bare, F.lit(1), colon - 1))))
    rule_names = ["allow", "disallow", "crawl-delay", "request-rate"]
    kind = (
        F.when(F.col("raw") == "", F.lit("blank"))
        .when(name == "user-agent", F.lit("agent"))
        .when(name.isin(*rule_names), F.lit("rule"))
    )
    value = urls.decode_percent(_value(bare))
    rows = lines.select(
        "domain", "line_no", kind.alias("kind"), name.alias("name"), value.alias("value")
    ).filter(F.col("kind").isNotNull())

    cuts = (F.col("kind") == "blank") | (
        (F.col("kind") == "agent")
        & (F.coalesce(F.lag("kind").over(_by_line()), F.lit("blank")) != "agent")
    )
    numbered = rows.withColumn("cuts", cuts.cast("int")).withColumn(
        "entry", F.sum("cuts").over(_by_line())
    )
    is_agent, is_rule = F.col("kind") == "agent", F.col("kind") == "rule"
    target = user_agent.split("/")[0].lower()
    agent = F.when(is_agent, F.col("value"))
    rule_path = _rule_path(F.col("value"))
    rule = F.struct(
        "line_no",
        ((F.col("name") == "allow") | (F.col("value") == "")).alias("allow"),
        rule_path.alias("path"),
    )
    entries = (
        numbered.groupBy("domain", "entry")
        .agg(
            F.bool_or(is_agent).alias("has_agent"),
            F.bool_or(is_rule).alias("has_rule"),
            F.coalesce(F.bool_or(agent == "*"), F.lit(False)).alias("is_default"),
            F.coalesce(F.bool_or(F.contains(F.lit(target), F.lower(agent))), F.lit(False)).alias("named"),
            F.array_sort(
                F.collect_list(F.when(F.col("name").isin("allow", "disallow"), rule))
            ).alias("rules"),
        )
        .filter("has_agent AND has_rule AND (is_default OR named)")
    )
    return entries.groupBy("domain").agg(
        F.min_by("rules", F.struct("is_default", "entry")).alias("rules")
    )


def _rule_path(value: Column) -> Column:
    """A '?' or '#' with nothing behind it says nothing."""
    no_fragment = F.regexp_replace(value, r"#\z", "")
    return F.regexp_replace(no_fragment, r"\A([^?#]*)\?(?=#|\z)", "$1")


def gate(pages: DataFrame, rules: DataFrame, follow: bool = True, url: str = "url") -> DataFrame:
    """Adds `allowed`: the first rule that is a prefix of the address decides, no rule means yes.

    The rules of a domain are one array, so a URL meets one row, and no grouping by URL follows the join.
    """
    if not follow:
        return pages.withColumn("allowed", F.lit(True))
    address, said = F.col(url), urls.decode_percent(F.col(url))
    cut = computed(pages, {"_cut": urls.pieces(address)})
    decoded = computed(
        cut, {"_said": F.when(F.contains(address, F.lit("%")), urls.pieces(said)).otherwise(F.col("_cut"))}
    )
    keyed = computed(
        decoded,
        {
            "_domain": urls.normalize_domain(urls.named(F.col("_cut"))["host"]),
            "_path": urls.robots_path_of(F.col("_said")),
        },
    ).drop("_cut", "_said")
    table = rules.select(F.col("domain").alias("_domain"), F.col("rules").alias("_rules"))
    first = F.get(
        F.filter("_rules", lambda r: F.startswith(F.col("_path"), r.path)), F.lit(0)
    ).allow
    return (
        keyed.join(table, "_domain", "left")
        .withColumn("allowed", F.coalesce(first, F.lit(True)))
        .drop("_domain", "_path", "_rules")
    )


def effective_delays(
    domains: DataFrame, delays: DataFrame, request_delay: float, obey: bool = True
) -> DataFrame:
    """(domain, delay_s): the larger of our own and the site's delay when obeyed."""
    own = F.lit(float(request_delay))
    joined = domains.join(delays, "domain", "left")
    value = F.greatest(own, F.coalesce("crawl_delay", own)) if obey else own
    return joined.withColumn("delay_s", value).drop("crawl_delay")


def refresh_intervals(pages: DataFrame, hints: DataFrame, url: str = "url") -> DataFrame:
    """Adds `refresh_s`: the interval of the longest prefix of the path, or NULL."""
    packed = hints.groupBy(F.col("domain").alias("_domain")).agg(
        F.collect_list(
            F.struct(F.length("prefix").alias("n"), F.col("interval_s").alias("s"), "prefix")
        ).alias("_hints")
    )
    keyed = computed(
        pages,
        {"_domain": urls.normalize_domain(urls.netloc(F.col(url))), "_path": urls.path(F.col(url))},
    )
    best = F.array_max(F.filter("_hints", lambda h: F.startswith(F.col("_path"), h.prefix)))
    return (
        keyed.join(packed, "_domain", "left")
        .withColumn("refresh_s", best.s)
        .drop("_domain", "_path", "_hints")
    )
