"""Repeated runs of lines: a suffix array over the sequences of line ids, built by prefix doubling.

Every place in a document begins a suffix of its lines. Ranks by the first 1, 2, 4, ... lines follow from each other:
a rank by 2k lines orders pairs of ranks by k, of the place itself and of the one k further on. Places whose rank nobody
shares drop out. Suffixes that agree in m lines are an interval of the array with a common prefix of at least m; its
members are found by two overlapping ranks. Of the places in an interval all but the first are later copies.

A run counts if it has `min_words` words. All lines of such a run lie in shortest windows with that many words that begin
or end at one of them, and each of these windows is in an interval of its own with the copies of that window. So the
array is needed to a depth of the longest shortest window, at most `min_words` lines, and no deeper.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtide.llm.words import row_key, slices
from webtide.plans.lineage import Scratch
from webtide.plans.order import with_global_index

MIN_WORDS = 50
_LINES = "key BINARY, doc_id BIGINT, seq INT, line INT, id BIGINT, ahead INT, behind INT"


def _cut(min_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per line with words: its id, and how many lines the shortest window that begins or ends with it has."""
    names = [x.split()[0] for x in _LINES.split(", ")]

    def one(text: str) -> tuple[np.ndarray, ...]:
        lines = text.split("\n")
        n = np.array([len(x.split()) for x in lines], np.int64)
        place = np.flatnonzero(n)
        ids = np.array([xxhash.xxh64_intdigest(lines[i].strip().encode()) for i in place.tolist()], np.uint64)
        upto = np.concatenate([[0], np.cumsum(n[place])])
        seq = np.arange(len(place))
        end = np.searchsorted(upto, upto[:-1] + min_words)  # first place with enough words before it
        begin = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
        ahead = np.where(end < len(upto), end - seq, 0)
        behind = np.where(upto[1:] >= min_words, seq + 1 - begin, 0)
        return seq, place, ids.view(np.int64), ahead, behind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                found = [one(t or "") for t in part.column("text").to_pylist()]
                size = np.array([len(f[0]) for f in found], np.int64)
                repeated = lambda c: part.column(c).take(pa.array(np.repeat(np.arange(len(part)), size)))
                kinds = (np.int32, np.int32, np.int64, np.int32, np.int32)
                columns = [pa.array(np.concatenate([f[j] for f in found]).astype(k)) for j, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([repeated("key"), repeated("doc_id"), *columns], names=names)

    return run


def _next_ranks(ranks: DataFrame, step: int, scratch: Scratch, name: str) -> tuple[DataFrame, int]:
    """(key, seq, rank) by twice as many lines, of places whose rank somebody shares."""
    further = ranks.select("key", (F.col("seq") - step).alias("seq"), F.col("rank").alias("then"))
    pairs, _ = scratch.save(ranks.join(further, ["key", "seq"]), f"{name}-pairs")
    shared = pairs.groupBy("rank", "then").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    # only distinct pairs are sorted: a line in a third of all documents is one row here
    numbered, _ = scratch.save(with_global_index(shared.select("rank", "then"), ["rank", "then"]), f"{name}-order")
    found, seen = scratch.save(pairs.join(numbered, ["rank", "then"]).select("key", "seq", F.col("ix").alias("rank")), name)
    return found, seen["rows"]


def repeated_windows(docs: DataFrame, min_words: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(lines, later): all lines with words, and the windows (key, seq, size) that copy an earlier place."""
    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines, seen = scratch.save(
        rows.mapInArrow(_cut(min_words), _LINES), "lines", F.max(F.greatest("ahead", "behind")).alias("deepest")
    )
    # a line that occurs once ends every run; equal rows count once
    repeated = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    # written, so that the join with it is dealt out by itself and a very common line can be split
    shared, _ = scratch.save(repeated.select("id"), "shared")
    active, _ = scratch.save(lines.join(shared, "id", "left_semi").dropDuplicates(["key", "seq"]), "active")
    windows = (
        active.filter(F.col("ahead") > 0).select("key", "doc_id", "seq", F.col("ahead").alias("size"))
        .unionByName(active.filter(F.col("behind") > 0).select("key", "doc_id", (F.col("seq") - F.col("behind") + 1).alias("seq"), F.col("behind").alias("size")))
        .distinct()
    )
    windows, _ = scratch.save(windows, "windows")

    named, depth, ranks, left = [], 1, active.select("key", "seq", F.col("id").alias("rank")), 1
    while depth <= (seen["deepest"] or 0) and left:
        here = windows.filter((F.col("size") >= depth) & (F.col("size") < 2 * depth))
        last = ranks.select("key", F.col("seq").alias("end"), F.col("rank").alias("then"))
        ended = here.join(ranks, ["key", "seq"]).withColumn("end", F.col("seq") + F.col("size") - depth)
        named.append(scratch.save(ended.join(last, ["key", "end"]).drop("end"), f"named{depth}")[0])
        ranks, left = _next_ranks(ranks, depth, scratch, f"ranks{2 * depth}")
        depth *= 2
    if not named:
        return lines, windows.select("key", "seq", "size").limit(0)
    whole = named[0]
    for more in named[1:]:
        whole = whole.unionByName(more)
    # an interval: same size and same ranks at both ends
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key", "seq")
    first = whole.groupBy("size", "rank", "then").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    several, _ = scratch.save(first.filter(F.col("n") > 1), "intervals")
    met = whole.join(several, ["size", "rank", "then"])
    later, _ = scratch.save(met.filter(place > F.col("first")).select("key", "seq", "size").distinct(), "later")
    return lines, later


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, key, n_lines, deleted, runs) of every row of `docs` (doc_id, text; others are ignored).

    n_lines: lines with words. deleted: numbers of deleted lines, counted from 0 over all lines. runs: the maximal
    runs they form (first, last), blank lines between them included. Order is by doc_id (null last), then by a hash
    of doc_id and text, then by place; a run may copy an earlier one of its own document. Lines are compared
    without white space at their ends. Null texts have no lines; rows alike in doc_id and text are one document: they get the
    same result and do not copy each other; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    lines, later = repeated_windows(docs, min_words, scratch)
    hit = later.select("key", F.explode(F.sequence(F.col("seq"), F.col("seq") + F.col("size") - 1)).alias("seq")).distinct()
    gone = lines.select("key", "seq", "line").distinct().join(hit, ["key", "seq"])
    entry = F.struct("line", "seq").alias("e")
    per_doc = gone.groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("d"))
    size = lines.dropDuplicates(["key", "seq"]).groupBy("key").agg(F.count(F.lit(1)).alias("n_lines"))
    starts = F.filter("d", lambda e, i: (i == 0) | (F.get("d", i - 1)["seq"] != e["seq"] - 1))
    ends = F.filter("d", lambda e, i: (i == F.size("d") - 1) | (F.get("d", i + 1)["seq"] != e["seq"] + 1))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a["line"].alias("first"), b["line"].alias("last")))
    found = per_doc.select("key", F.col("d.line").alias("deleted"), runs.alias("runs"))
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("key"))
    return known.join(size, "key", "left").join(found, "key", "left").select(
        "doc_id",
        "key",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("deleted", F.array().cast("array<int>")).alias("deleted"),
        F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("runs"),
    )


def without_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` in all columns, later copies of runs deleted from the texts; documents with nothing left keep ""."""
    scratch = Scratch(docs.sparkSession)
    found, _ = scratch.save(deletions(docs, min_words).filter(F.size("deleted") > 0).dropDuplicates(["key"]), "deletions")
    cuts = found.select("key", F.col("deleted").alias("_deleted"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), row_key().alias("key"))
    lines = F.split("_doc.text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_deleted"))
    text = F.when(F.col("_deleted").isNull(), F.col("_doc.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    both = keyed.join(cuts, "key", "left").withColumn("_text", text)
    return both.select(*[(F.col("_text") if c == "text" else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
