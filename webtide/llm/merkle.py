"""Document fingerprints: a Merkle tree over sections and their paragraphs.

A section ends with a run of line ends, a paragraph inside it with a sentence end. Leaves are hashes of paragraphs,
a section's node hashes its leaves, the root hashes the sections. Pieces keep their separators, so equal roots mean
equal texts. The fingerprint is text: the root, then each section's node and leaves, shortened:
`root|node:leaf leaf|node:leaf`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtide.plans.once import computed

_SECTION = r"(?<=\n)(?!\n)"
_PARAGRAPH = r"(?<=[.!?]\x20)(?!\x20)"
#: Documents per bucket of the order by doc_id, and the most buckets there are.
_BUCKET, _BUCKETS = 2000, 1 << 14
_SIDE = 1 << 7


def _hex(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.xxhash64(c))), 16, "0")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column; null like empty: a root without sections."""
    whole = F.coalesce(F.col(text), F.lit(""))
    leaves = F.transform(
        F.filter(F.split(whole, _SECTION, -1), lambda s: s != ""),
        lambda s: F.transform(F.filter(F.split(s, _PARAGRAPH, -1), lambda p: p != ""), _hex),
    )
    df = computed(df, {"_leaves": leaves})
    df = computed(df, {"_nodes": F.transform("_leaves", lambda x: _hex(F.array_join(x, " ")))})
    root = F.substring(F.sha2(F.array_join("_nodes", ","), 256), 1, 32)
    short = lambda h: F.substring(h, 1, 8)
    branches = F.zip_with(
        "_nodes", "_leaves", lambda n, x: F.concat(short(n), F.lit(":"), F.array_join(F.transform(x, short), " "))
    )
    return computed(df, {name: F.array_join(F.concat(F.array(root), branches), "|")}).drop("_leaves", "_nodes")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the shared nodes by all nodes of both fingerprints (Dice), from 0 to under 1."""
    nodes = lambda c: F.array_distinct(F.split(c, r"[|: ]"))
    shared = F.size(F.array_intersect(nodes(a), nodes(b)))
    both = F.size(nodes(a)) + F.size(nodes(b))
    return F.when(a == b, F.lit(1.0)).otherwise(2.0 * shared / both)


def differing(a: Column, b: Column) -> Column:
    """Numbers from 0 of the sections of `a` whose node is not among those of `b`: where an edit is."""
    branches = lambda c: F.slice(F.split(c, r"\|"), 2, F.size(F.split(c, r"\|")))
    node = lambda s: F.substring_index(s, ":", 1)
    theirs = F.transform(branches(b), node)
    marked = F.transform(branches(a), lambda s, i: F.when(~F.array_contains(theirs, node(s)), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _bucket(bounds: list[int]) -> Column:
    """How many bounds are at most doc_id: 0 for a null one. Counted in two steps, so thousands are no burden."""
    if not bounds:
        return F.lit(0)
    rows = [bounds[i : i + _SIDE] for i in range(0, len(bounds), _SIDE)]
    below = lambda values: F.size(F.filter(values, lambda b: F.coalesce(b <= F.col("doc_id"), F.lit(False))))
    top = below(F.lit([r[0] for r in rows]))
    fine = below(F.get(F.array(*[F.lit(r) for r in rows]), F.greatest(top - 1, F.lit(0))))
    return F.when(top == 0, F.lit(0)).otherwise((top - 1) * _SIDE + fine)


def with_next(docs: DataFrame, ids: DataFrame, carried: list[str]) -> DataFrame:
    """Adds `next_<c>` of the document that follows by doc_id (a null one first; ties by text hash); the first
    follows the last. `ids` has the doc_id of every row; it is read twice, and texts once.

    Buckets of the order come from quantiles of doc_id, so one shuffle by bucket and a window do; the first document
    of each bucket goes into the one before as well. The driver sees two numbers per bucket, `_BUCKETS` at most.
    """
    n = ids.count()
    count = min(_BUCKETS, n // _BUCKET)
    bounds: list[int] = []
    if count > 1:
        shares = F.lit([i / count for i in range(1, count)])
        cut = ids.agg(F.percentile_approx("doc_id", shares, F.lit(20 * count)).alias("b")).head()
        bounds = sorted(set(cut.b or []))
    nulls = F.count_if(F.col("doc_id").isNull())
    found = ids.withColumn("_bucket", _bucket(bounds)).groupBy("_bucket").agg(F.when(nulls == 0, F.min("doc_id")).alias("first")).collect()
    order = sorted(((r["_bucket"], r["first"]) for r in found), key=lambda x: x[0])
    if not order:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    size = len(bounds) + 1
    first, before = [None] * size, [0] * size
    for i, (bucket, doc_id) in enumerate(order):
        first[bucket], before[bucket] = doc_id, order[i - 1][0]
    at = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("_bucket"))
    leads = F.col("doc_id").eqNullSafe(at(first, "bigint"))
    here = F.struct(F.lit(False).alias("guest"), F.col("_bucket").alias("bucket"))
    there = F.struct(F.lit(True).alias("guest"), at(before, "int").alias("bucket"))
    seats = F.when(leads, F.array(here, there)).otherwise(F.array(here))
    seated = docs.withColumn("_bucket", _bucket(bounds)).withColumn("_seat", F.explode(seats)).select(*docs.columns, "_seat.*")
    order_by = Window.partitionBy("bucket").orderBy("guest", F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    follow = {f"next_{c}": F.lead(c).over(order_by) for c in carried}
    return seated.withColumns(follow).filter(~F.col("guest")).drop("guest", "bucket")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text of `docs` (doc_id, text; others are ignored) and of an edited one.

    Edited: the last floor(n/2) code points give way to the first as many of the next document. Columns: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text is an empty one, and
    texts without paragraphs are equal to each other. Repeated rows follow each other as any two documents; one
    document alone follows itself; an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    pairs = with_next(with_fingerprint(rows, "text", "fingerprint"), rows.select("doc_id"), ["text", "fingerprint"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    pairs = computed(pairs, {"n_chars": n.cast("bigint"), "edited": edited})
    pairs = with_fingerprint(pairs, "edited", "edited_fingerprint")
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
