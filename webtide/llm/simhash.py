"""Near-duplicates by 64-bit SimHash, linked through an inverted index on bytes at their positions.

Two fingerprints with at most `max_bits` = 4 differing bits agree in at least 8 - 4 of their 8 bytes. The index
therefore has one entry for each choice of 4 positions and the bytes found there (70 per distinct fingerprint):
pairs that meet in an entry share the guaranteed minimum, all others cannot be near. A pair's shared bytes are
counted and its differing bits verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtide.llm.components import components
from webtide.llm.words import row_key
from webtide.plans.lineage import Scratch

MAX_BITS = 4
#: Entries with more members take the other exact way, `_around`.
PAIRWISE = 256
_CHUNK = 1 << 16


def fingerprint(text: bytes, width: int = 4) -> int:
    """SimHash of UTF-8 text: words without white space, A-Z lowered, shingles of `width` words with repeats."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    last = end[min(width, len(words)) - 1 :].tolist()
    first = (end - size)[: len(last)].tolist()
    ones, hash_of = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), _CHUNK):
        spans = zip(first[at : at + _CHUNK], last[at : at + _CHUNK])
        h = np.array([hash_of(joined[a:b], 42) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(first), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = [fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in batch.column("text")]
        columns = [batch.column("doc_id"), batch.column("key"), pa.array(fp, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp) of every whole text; a null text has the fingerprint of an empty one, zero."""
    text = F.col("text").cast("string").cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("key"), text.alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id BIGINT, key BINARY, fp BIGINT")


def _near(a: str, b: str) -> Column:
    """Enough shared bytes, and few differing bits."""
    differ = F.col(a).bitwiseXOR(F.col(b))
    shared = sum(
        (F.when(differ.bitwiseAND(F.lit(_mask((p,)))) == 0, 1).otherwise(0) for p in range(8)), F.lit(0)
    )
    return (shared >= 8 - MAX_BITS) & (F.bit_count(differ) <= MAX_BITS)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mask(positions: tuple[int, ...]) -> int:
    return _signed(sum(0xFF << (8 * p) for p in positions))


def _entries(distinct: DataFrame) -> DataFrame:
    """(choice, bytes, fp): the inverted index."""
    masks = [_mask(c) for c in combinations(range(8), 8 - MAX_BITS)]
    found = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])
    return distinct.select("fp", F.posexplode(found).alias("choice", "bytes"))


def _links_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by entry. Near pairs of each entry, as far as they connect what was not yet connected."""
    kept = np.zeros((3, 0), np.int64)
    for batch in batches:
        rows = np.concatenate([kept, np.stack([batch.column(i).to_numpy() for i in range(3)])], axis=1)
        new = np.flatnonzero(np.any(rows[:2, 1:] != rows[:2, :-1], axis=0))
        cut = int(new[-1]) + 1 if len(new) else 0
        yield _forest(rows[:, :cut])
        kept = rows[:, cut:]
    yield _forest(kept)


def _forest(rows: np.ndarray) -> pa.RecordBatch:
    choice, key, fp = rows
    parent: dict[int, int] = {}
    links: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    at = np.arange(len(fp))
    for step in range(1, len(fp)):
        at = at[at + step < len(fp)]
        at = at[(choice[at] == choice[at + step]) & (key[at] == key[at + step])]
        if not len(at):
            break
        differ = np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64))
        near = at[differ <= MAX_BITS]
        for a, b in zip(fp[near].tolist(), fp[near + step].tolist()):
            if (x := root(a)) != (y := root(b)):
                parent[x] = y
                links.append((a, b))
    pair = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])


def _around(crowded: DataFrame) -> DataFrame:
    """Links among fingerprints of crowded entries, without comparing pairs.

    Each writes down all values within `MAX_BITS` / 2 bits of it (2,081). Two are near exactly if they wrote the
    same value, and all that wrote one are near each other, so each links to the least of them.
    """
    flips = [0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i, j in combinations(range(64), 2))]
    values = F.transform(F.lit([_signed(m) for m in flips]), lambda m: m.bitwiseXOR(F.col("a")))
    written = crowded.select(F.col("fp").alias("a")).withColumn("value", F.explode(values))
    least = F.min("a").over(Window.partitionBy("value"))  # 2,081 rows at most
    return written.select("a", least.alias("b")).filter(F.col("a") != F.col("b")).distinct()


def near_links(distinct: DataFrame, scratch: Scratch, pairwise: int = PAIRWISE) -> DataFrame:
    """(a, b) pairs of fingerprints that connect all distinct ones (column fp) within `MAX_BITS` bits.

    Every pair in them is near; of near pairs that are connected otherwise some are left out. Entries with one
    member fall out in the first aggregation, those with two are pairs already, up to `pairwise` members are
    compared within a task, and members of still larger ones are linked by `_around`, exactly as well.
    """
    entry = ["choice", "bytes"]
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = distinct.repartition(tasks)  # a few bytes per row until here, 70 rows from here
    counted = _entries(distinct).groupBy(*entry).agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    shared, _ = scratch.save(counted.filter(F.col("n") > 1), "entries")
    two = shared.filter((F.col("n") == 2) & _near("a", "b")).select("a", "b").distinct()
    more = shared.filter(F.col("n") > 2).select(*entry, "n")
    # as a merge join at every size: its hot entries can be split, and its cost follows the input
    members, _ = scratch.save(_entries(distinct).join(more.hint("merge"), entry), "members")
    few = members.filter(F.col("n") <= pairwise).select(*entry, "fp")
    sorted_ = few.select(F.col("choice").cast("bigint").alias("choice"), "bytes", "fp").repartition(*entry)
    within = sorted_.sortWithinPartitions(*entry).mapInArrow(_links_within, "a BIGINT, b BIGINT")
    crowded = members.filter(F.col("n") > pairwise).select("fp").distinct()
    return two.unionByName(within).unionByName(_around(crowded))


def groups(docs: DataFrame, scratch: Scratch, pairwise: int = PAIRWISE) -> DataFrame:
    """(doc_id, key, fp, component) of every row; component is a fingerprint, the least of those that are linked to it.

    Fingerprints are the nodes, so what rows have for a doc_id, or whether they have one, links or parts nothing.
    """
    rows, _ = scratch.save(fingerprints(docs), "fingerprints")
    distinct, _ = scratch.save(rows.select("fp").distinct(), "distinct")
    links, _ = scratch.save(near_links(distinct, scratch, pairwise), "links")
    joined = components(links.select("a", "b"), scratch).select(F.col("node").alias("fp"), "component")
    known, _ = scratch.save(distinct.join(joined, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component")), "known")
    return rows.join(known, "fp").select("doc_id", "key", "fp", "component")


def near_duplicates(docs: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs` (doc_id, text; others are ignored).

    Equal fingerprints are one node before anything is compared. component_id is the smallest doc_id reachable over
    links. Null and empty texts have fingerprint zero and are linked like any other; repeated rows give repeated rows,
    and rows with one doc_id are each judged by their own text; component_id is null where no row reached has a doc_id.
    An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    found, _ = scratch.save(groups(docs, scratch, pairwise), "groups")
    least, _ = scratch.save(found.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    named = found.join(least, "component")
    return named.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, in all its columns: the one with the smallest doc_id.

    Rows without doc_id come after those with one; of several rows with that doc_id the one whose key is least, and of
    rows alike in doc_id and text any one. Every row is judged by its own text, whatever doc_id it shares.
    """
    scratch = Scratch(docs.sparkSession)
    found = groups(docs, scratch)
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    counted = found.groupBy("component", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    chosen = counted.groupBy("component").agg(F.min_by(F.struct("key", "n"), first).alias("c")).select("c.*")
    chosen, _ = scratch.save(chosen, "chosen")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), row_key().alias("key"))
    alone = keyed.join(chosen.filter(F.col("n") == 1).select("key"), "key", "left_semi")
    again = keyed.join(chosen.filter(F.col("n") > 1).select("key"), "key", "left_semi").dropDuplicates(["key"])
    return alone.unionByName(again).select("_doc.*")
