"""Personal data: regular expressions propose spans, checksums confirm them, words nearby move their score.

A kind is a pattern, a test and a score. Spans count in code points, ends exclusive. Patterns are possessive and
start at run ends, so no text makes them backtrack: `\\G` admits the place where the match before ended.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.plans.once import computed

#: Elements summed in one go when places are added up; see `_places`.
_BLOCK = 128
_NEAR = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _ip_parts(match: Column) -> Column:
    return match.rlike(r"\A(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|\z)){4}")


def _luhn(low: int, high: int) -> Callable[[Column], Column]:
    def test(match: Column) -> Column:
        d = _digits(match)
        return F.length(d).between(low, high) & F.call_function("luhn_check", d)

    return test


def _mod97(match: Column) -> Column:
    """The account number rule: first four signs to the end, letters as 10..35, remainder 1."""
    tight = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(tight, 5, 40), F.substring(tight, 1, 4))
    step = lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97
    ).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


#: How keys of some services begin, as these document them.
_PREFIXED = (
    r"(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
    r"|AIza[A-Za-z0-9_-]{35}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}+|glpat-[A-Za-z0-9_-]{20}|hf_[A-Za-z0-9]{34})"
)


def _distinct(match: Column, least: int) -> Column:
    return F.size(F.array_distinct(F.split(match, ""))) > least  # one part is empty


def _random(match: Column) -> Column:
    """Looks drawn by chance: many different signs, digits among them, and hex or letters of both cases."""
    shape = match.rlike(r"\A(?:[0-9a-f]++|[0-9A-F]++)\z") | (match.rlike("[a-z]") & match.rlike("[A-Z]"))
    return shape & match.rlike("[A-Za-z]") & (F.length(_digits(match)) >= 3) & _distinct(match, 9) & ~match.rlike(_PREFIXED)


def _ssn(match: Column) -> Column:
    """Numbers that can have been issued: no area 000, 666 or from 900 on, no group 00, no serial 0000."""
    return ~match.rlike(r"\A(?:000|666|9)|-00-|0000\z")


@dataclass(frozen=True)
class Kind:
    """score: of a confirmed span; `words` nearby add 0.4. Spans under the threshold are dropped, but not base ones."""

    name: str
    pattern: str
    test: Callable[[Column], Column] | None
    score: float
    words: tuple[str, ...]
    base: bool = True
    needs: str = ""  # a sign without which there is no match


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         None, 0.9, ("mail", "contact"), needs="@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip_parts, 0.6, ("ip", "server", "host"), needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _luhn(14, 19), 0.8, ("card", "credit", "visa", "payment")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(10, 15), 0.6,
         ("phone", "tel", "call", "mobile"), needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", _mod97, 0.8,
         ("iban", "account", "bank"), base=False),
    # these two count only with words around them
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _ssn, 0.2,
         ("ssn", "social security"), base=False, needs="-"),
    Kind("secret", r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{20,}+", _random, 0.2,
         ("[a-z0-9_-]*(?:secret|token|password|passwd|credential)", "[a-z0-9_-]*api[ _-]?key", "[a-z0-9]*(?:access|private|auth)[ _-]?key", "bearer"),
         base=False),
    Kind("key", r"(?<![A-Za-z0-9_+/-])" + _PREFIXED + r"(?![A-Za-z0-9_])", lambda m: _distinct(m, 9), 0.7,
         ("key", "secret", "token"), base=False),
)
THRESHOLD = 0.5


def _places(size: Column) -> Column:
    """Sums of all sizes up to each block of `_BLOCK`, first 0: few steps even for very many sizes."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(size) - 1, F.lit(0)), F.lit(_BLOCK))
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    sums = F.transform(starts, lambda i: total(F.slice(size, i + 1, F.lit(_BLOCK))))
    return F.aggregate(
        sums, F.array(F.lit(0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s))
    )


def _spans(kind: Kind, k: str) -> Column:
    """Tested spans of a kind from its columns: matches, gap sizes, sizes of gap and match, places of blocks."""
    match, gap, both, block = (F.col(f"{k}_{c}") for c in ("match", "gap", "both", "block"))

    def one(m: Column, i: Column) -> Column:
        inner = F.aggregate(
            F.slice(both, i - i % _BLOCK + 1, i % _BLOCK), F.lit(0), lambda a, x: a + x
        )
        start = F.get(block, (i / _BLOCK).cast("int")) + inner + F.get(gap, i)
        return F.struct(start.alias("start"), m.alias("match"))

    placed = F.transform(match, one)
    tested = placed if kind.test is None else F.filter(placed, lambda s: kind.test(s["match"]))
    words = "|".join(kind.words)
    around = lambda s: F.lower(
        F.substring(F.col("_text"), F.greatest(s["start"] - _NEAR + 1, F.lit(1)), F.length(s["match"]) + 2 * _NEAR)
    )
    return F.transform(
        tested,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            (s["start"] + F.length(s["match"])).alias("end"),
            F.lit(kind.name).alias("kind"),
            F.lit(kind.base).alias("base"),
            (F.lit(kind.score) + F.when(around(s).rlike(rf"\b(?:{words})"), 0.4).otherwise(0.0)).alias("score"),
        ),
    )


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row of `docs` (doc_id, text; others are ignored).

    spans: array of (start, rank, end, kind, base, score), by start, then kind. A null text is an empty one and has
    none; repeated rows give repeated results; an empty table gives no rows. Per kind, matches are leftmost and do
    not overlap, those that fail their test are dropped and not tried again. All in one pass without a shuffle:
    matches and the gaps between them come from the pattern, places from adding up their sizes in blocks.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    text = F.col("_text")
    found = {}
    for kind in KINDS:
        hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        none = F.array().cast("array<string>")
        found[f"{kind.name}_match"] = F.when(F.contains(text, F.lit(kind.needs)), hits).otherwise(none) if kind.needs else hits
    rows = computed(rows, found)
    sizes = lambda c: F.transform(c, F.length)
    some = lambda kind, c: F.when(F.size(f"{kind.name}_match") > 0, c)
    rows = computed(rows, {f"{k.name}_gap": some(k, sizes(F.split(text, k.pattern, -1))) for k in KINDS})
    both = lambda k: F.zip_with(F.col(f"{k.name}_gap"), sizes(F.col(f"{k.name}_match")), lambda g, m: g + F.coalesce(m, F.lit(0)))
    rows = computed(rows, {f"{k.name}_both": some(k, both(k)) for k in KINDS})
    rows = computed(rows, {f"{k.name}_block": some(k, _places(F.col(f"{k.name}_both"))) for k in KINDS})
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,base:boolean,score:double>>")
    spans = F.concat(*[F.coalesce(some(k, _spans(k, k.name)), empty) for k in KINDS])
    kept = F.filter(spans, lambda s: s["base"] | (s["score"] >= THRESHOLD))
    return computed(rows, {"spans": F.array_sort(kept)}).select("doc_id", "spans")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of base kinds and of all spans, checksum of base spans, and all spans and their scores as text."""
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("bigint")
    counts = {f"n_{k.name}": count(k.name) for k in KINDS if k.base}
    base = listed(F.filter("spans", lambda s: s["base"]))
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in counts.items()],
        F.sha2(base, 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 1)), ",").alias("scores"),
    )
