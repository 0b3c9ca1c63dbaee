"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has `nodes` points on a ring; a document belongs to the first point clockwise of its own. A shard has
room for its share of the rows: floor or ceiling of rows / shards, times 1 + slack. Documents that find a full shard
continue clockwise to the next point whose shard has room. With slack 0 the counts differ by one at most.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from webtide.plans.lineage import Scratch

#: Places on the ring. Arcs between points end on places, so a lookup by place has a fixed size.
PLACES = 1 << 16
_SPANS = "array<struct<arc:int,lo:bigint,hi:bigint,shard:int,slot:bigint>>"


def ring(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """(place, arc, shard) of all `PLACES`: arc numbers the point clockwise of a place, shard owns it.

    A shard's points depend on its number only, so one shard more leaves all other points where they are.
    """
    point = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.expr(f"id div {shards}").alias("replica")
    )
    at = point.withColumn("place", F.pmod(F.xxhash64(F.lit("point"), "shard", "replica"), F.lit(PLACES)))
    points = at.groupBy("place").agg(F.min("shard").alias("shard"))
    # fixed sizes: one row per point, one per place
    numbered = points.withColumn("arc", F.row_number().over(Window.orderBy("place")) - 1)
    places = spark.range(PLACES).withColumnRenamed("id", "place").join(numbered, "place", "left")
    ahead = Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    ever = Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # beyond the last point the first one follows
    clockwise = lambda c: F.coalesce(F.last(c, True).over(ahead), F.last(c, True).over(ever))
    return places.select("place", clockwise("arc").cast("int").alias("arc"), clockwise("shard").alias("shard"))


def spans(owners: list[int], counts: list[int], shards: int, slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(arc, lo, hi, shard, slot): where the documents ranked lo..hi-1 of each arc go, and the slot of the first.

    Input is one number per arc, a fixed size. All arcs advance together: what does not fit goes to the next point
    clockwise with room, so each wave places everything or fills at least one shard.
    """
    total = sum(counts)
    room = [int((total // shards + (s < total % shards)) * (1 + slack)) for s in range(shards)]
    placed = [0] * len(owners)
    at = list(range(len(owners)))
    waiting = [a for a, n in enumerate(counts) if n]
    found: list[tuple[int, int, int, int]] = []
    while waiting:
        for arc in waiting:
            while not room[owners[at[arc]]]:
                at[arc] = (at[arc] + 1) % len(owners)
        left = []
        for arc in sorted(waiting, key=lambda a: at[a]):
            shard, lo = owners[at[arc]], placed[arc]
            take = min(counts[arc] - lo, room[shard])
            if take:
                found.append((arc, lo, lo + take, shard))
                placed[arc] += take
                room[shard] -= take
            if placed[arc] < counts[arc]:
                left.append(arc)
        waiting = left
    filled, out = [0] * shards, []
    for arc, lo, hi, shard in sorted(found):
        out.append((arc, lo, hi, shard, filled[shard]))
        filled[shard] += hi - lo
    return out


def assign(docs: DataFrame, shards: int, nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of `docs` (doc_id, text; others are ignored).

    size: UTF-8 bytes of the text (none if null) plus 16. slot counts from 0 in each shard without gaps. Null
    doc_ids share one place; repeated rows are placed one by one; an empty table gives no rows. Ties go by doc_id,
    checksum and size. Texts are read once and never shuffled; only four numbers per row are, by arc.
    """
    scratch = Scratch(docs.sparkSession)
    circle = _circle(docs.sparkSession, scratch, shards, nodes, slack)
    narrow, _ = scratch.save(_on_ring(docs.select(*_numbers()), circle), "rows")
    placed = _placed(narrow, _plan(narrow, circle, shards, slack), "text_crc32", "size")
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, nodes: int = 64, slack: float = 0.0) -> None:
    """Write every row of `docs` to `<path>/shard=<n>`: all its columns as the struct `_doc`, and its slot.

    Shards and slots are those of `assign`; rows alike in all it orders by go by a hash of all columns. A file holds
    rows of one shard ordered by slot. The plan takes one pass over doc_id; then rows move once, by groups of one
    shard's arcs, so that a task writes into few shards, and their places are found where they arrive.
    """
    scratch = Scratch(docs.sparkSession)
    circle = _circle(docs.sparkSession, scratch, shards, nodes, slack)
    plan = _plan(_on_ring(docs.select(_turn()), circle), circle, shards, slack)
    # maps have no hash
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.xxhash64(*plain).alias("tie"), *_numbers())
    part = (F.col("home") * 8 + F.col("arc") % 8).alias("part")
    moved = _on_ring(whole, circle, "home").select("*", part).repartition("part")
    placed = _placed(moved, plan, "text_crc32", "size", "tie", group=("part",)).select("_doc", "slot", "shard")
    seen = Observation()
    placed.observe(seen, F.count(F.lit(1)).alias("rows")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
    if seen.get["rows"] != sum(p[2] - p[1] for p in plan):
        raise RuntimeError("the documents changed between the two passes over them")


def read_shards(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """(_doc, slot, shard) of what `write_shards` wrote of `docs`."""
    kind = StructType([StructField("_doc", docs.schema), StructField("slot", LongType()), StructField("shard", IntegerType())])
    return spark.read.schema(kind).parquet(path)


def digests(sharded: DataFrame) -> DataFrame:
    """The columns of `assign`, worked out from the documents in the shards."""
    doc_id, size, text_crc32 = _numbers("_doc.")[:3]
    return sharded.select(doc_id, size, text_crc32, "shard", "slot")


def _turn(prefix: str = "") -> Column:
    return F.xxhash64(F.lit("document"), F.col(f"{prefix}doc_id").cast("bigint")).alias("turn")


def _numbers(prefix: str = "") -> list[Column]:
    text = F.coalesce(F.col(f"{prefix}text").cast("string"), F.lit(""))
    return [
        F.col(f"{prefix}doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _turn(prefix),
    ]


def _circle(spark: SparkSession, scratch: Scratch, shards: int, nodes: int, slack: float) -> DataFrame:
    if shards < 1 or nodes < 1 or shards * nodes > PLACES // 2 or slack < 0:
        raise ValueError("need shards and nodes >= 1, shards * nodes <= PLACES / 2, slack >= 0")
    return scratch.save(ring(spark, shards, nodes), "ring")[0]


def _on_ring(rows: DataFrame, circle: DataFrame, home: str | None = None) -> DataFrame:
    """`rows` (turn) with the arc each is on, and as `home` the shard of its point."""
    # PLACES rows
    arcs = F.broadcast(circle.select("place", "arc", *([F.col("shard").alias(home)] if home else [])))
    return rows.withColumn("place", F.pmod("turn", F.lit(PLACES))).join(arcs, "place").drop("place")


def _plan(on: DataFrame, circle: DataFrame, shards: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    # one number per arc, shards * nodes of them at most
    owners = dict(circle.select("arc", "shard").distinct().collect())
    counts = dict(on.groupBy("arc").count().collect())
    order = sorted(owners)
    return spans([owners[a] for a in order], [counts.get(a, 0) for a in order], shards, slack)


def _placed(on: DataFrame, plan: list[tuple[int, int, int, int, int]], *ties: str, group: tuple[str, ...] = ()) -> DataFrame:
    """`on` with shard and slot; `group` are columns that follow from the arc and by which rows are dealt already."""
    literal = json.dumps([dict(zip(("arc", "lo", "hi", "shard", "slot"), s)) for s in plan])
    whole = on.sparkSession.range(1).select(F.inline(F.from_json(F.lit(literal), _SPANS)))
    ranked = on.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*group, "arc").orderBy("turn", "doc_id", *ties)) - 1
    )
    within = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    # about one row per arc
    placed = ranked.join(F.broadcast(whole.withColumnRenamed("arc", "_arc")), (F.col("arc") == F.col("_arc")) & within)
    return placed.withColumn("slot", F.col("slot") + F.col("rank") - F.col("lo"))
