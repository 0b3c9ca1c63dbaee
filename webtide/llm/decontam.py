"""Benchmark decontamination by spaced seeds: overlaps of test items and documents that tolerate other words.

A seed is a mask over a few words in a row; the words at its open places are hashed, the others may be anything.
Seeds of items and documents are joined; each meeting gives an alignment (a document, an item and the distance of
their places), along which the words are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtide.llm.words import WORDS, mix, row_key, slices, split
from webtide.plans.lineage import Scratch


@dataclass(frozen=True)
class Seeds:
    """An overlap is a run of `window` aligned words (all of a shorter item) of which the `share` agrees.

    The given masks reach every overlap of the given window and share; other ones ask for masks of their own. Items
    of fewer than `window` words have the masks of `whole`, which reach every overlap whatever window and share are.
    """

    masks: tuple[str, ...] = ("1101100101", "1100101011", "1011010011", "1111110000")
    window: int = 13
    share: float = 0.8

    def __post_init__(self) -> None:
        if not self.masks or any(set(m) - {"0", "1"} or m[0] != "1" for m in self.masks) or not 0 < self.share <= 1:
            raise ValueError("masks are of 0 and 1 and begin with 1; 0 < share <= 1")

    def whole(self, words: int) -> list[str]:
        """Masks as wide as an item of so many words. However the changed words lie, one mask has none at its open places.

        The item is cut into more groups than words may change, and each mask leaves out as many groups: up to 12 masks
        if groups are to be had (with one changed word, each leaves out one word), else one group more than words.
        """
        changed = words - ceil(self.share * words - 1e-9)
        groups = max((g for g in range(changed + 1, words + 1) if comb(g, changed) <= 12), default=changed + 1)
        of = [i * groups // words for i in range(words)]
        return ["".join("01"[g not in out] for g in of) for out in combinations(range(groups), changed)]


#: Bits of the sieve: a fixed size, whatever the size of the benchmark.
_SIEVE = 26
_ODD = np.arange(1, 128, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def _seeded(h: np.ndarray, at: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of a mask wherever it fits into a text."""
    width = len(mask)
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(number))
    for i, c in enumerate(mask):
        if c == "1":
            total += h[i : i + n] * _ODD[i]
    last = np.repeat(at[1:], np.diff(at))[:n]
    place = np.flatnonzero(np.arange(n) + width <= last)
    return place, mix(total[place])


def _probes(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the sieve, from bits of the seed that do not overlap."""
    return seed >> np.uint64(64 - _SIEVE), seed & np.uint64((1 << _SIEVE) - 1)


def _item_seeds(seeds: Seeds, h: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Seeds of items: the masks anywhere in those of `window` words or more, masks as wide as the item in others."""
    size = np.diff(at)
    of = np.repeat(size, size)  # words of the item that a place lies in
    for number, mask in enumerate(seeds.masks):
        place, seed = _seeded(h, at, mask, number)
        long = of[place] >= seeds.window
        yield place[long], seed[long]
    for words in np.unique(size[(size > 0) & (size < seeds.window)]).tolist():
        for number, mask in _whole(seeds, words):
            place, seed = _seeded(h, at, mask, number)
            all_of_it = of[place] == words
            yield place[all_of_it], seed[all_of_it]


def _whole(seeds: Seeds, words: int) -> list[tuple[int, str]]:
    """Numbered masks of items of so many words; the numbers are those of no other mask."""
    first = len(seeds.masks) + sum(len(seeds.whole(n)) for n in range(1, words))
    return list(enumerate(seeds.whole(words), first))


def _scan(seeds: Seeds, sieve, lengths: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(row, id, key, words, seeds) of each text; words only where the sieve lets a seed through.

    Without a sieve the texts are items. lengths: numbers of words, under `window`, that items have.
    """
    masks = [*enumerate(seeds.masks), *(m for words in lengths for m in _whole(seeds, words))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if sieve is None else np.frombuffer(sieve.value, np.uint8)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                w = split(batch.column("text")[lo:hi], WORDS)
                h = w.hashes()
                found = list(_item_seeds(seeds, h, w.at)) if bits is None else []
                for number, mask in masks if bits is not None else ():
                    place, seed = _seeded(h, w.at, mask, number)
                    for which in range(2):
                        probe = _probes(seed)[which]
                        hit = (bits[probe >> np.uint64(3)] >> (probe & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        place, seed = place[hit], seed[hit]
                    found.append((place, seed))
                place = np.concatenate([p for p, _ in found])
                order = np.argsort(place, kind="stable")
                place, seed = place[order], np.concatenate([s for _, s in found])[order]
                n = hi - lo
                cut = np.searchsorted(place, w.at)
                size = np.diff(w.at)
                wanted = (np.diff(cut) > 0) | (bits is None)
                words = h[np.repeat(wanted, size)].view(np.int64)
                inside = place - np.repeat(w.at[:-1], np.diff(cut))
                lists = lambda values, ends: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)
                pairs = pa.StructArray.from_arrays([pa.array(inside.astype(np.int32)), pa.array(seed.view(np.int64))], names=["place", "seed"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        batch.column("id")[lo:hi],
                        batch.column("key")[lo:hi],
                        lists(pa.array(words), np.cumsum(np.where(wanted, size, 0))),
                        lists(pairs, cut[1:]),
                    ],
                    names=["row", "id", "key", "words", "seeds"],
                )
                row += n

    return run


_SCANNED = "row BIGINT, id BIGINT, key BINARY, words ARRAY<BIGINT>, seeds ARRAY<STRUCT<place: INT, seed: BIGINT>>"


def _scanned(rows: DataFrame, id_column: str, seeds: Seeds, sieve=None, lengths: Sequence[int] = ()) -> DataFrame:
    text = F.col("text").cast("string").alias("text")
    # items have no key: nothing is done to them
    key = row_key() if id_column == "doc_id" else F.lit(None).cast("binary")
    plain = rows.select(F.col(id_column).cast("bigint").alias("id"), key.alias("key"), text)
    return plain.mapInArrow(_scan(seeds, sieve, lengths), _SCANNED)


def _sieve(item_seeds: DataFrame) -> bytes:
    """Bits of all item seeds. Gathered by words of 64 bits, so what comes to the driver has a fixed bound."""
    low = F.col("seed").bitwiseAND(F.lit((1 << _SIEVE) - 1))
    probe = F.explode(F.array(F.shiftrightunsigned("seed", 64 - _SIEVE), low))
    words = item_seeds.select(probe.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits")
    )
    out = np.zeros(1 << (_SIEVE - 6), "<i8")
    got = words.toArrow()  # 2^20 rows at most, as two columns: rows of Python would take many times the sieve
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return out.tobytes()


def _verify(seeds: Seeds) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["row", "item_id", "first", "matched", "compared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("row", "item_id", "first", "theirs", "ours", "length")]
            for row, item, first, theirs, ours, length in zip(*(columns[i].to_pylist() for i in (0, 1, 2)), columns[3], columns[4], columns[5].to_pylist()):
                same = theirs.values.to_numpy() == ours.values.to_numpy()
                width = min(seeds.window, length)
                if len(same) < width:
                    continue
                total = np.concatenate([[0], np.cumsum(same)])
                window = total[width:] - total[:-width]
                best = int(window.argmax())
                if window[best] >= seeds.share * width - 1e-9:
                    out.append((row, item, first + best, int(window[best]), width))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds()) -> tuple[DataFrame, DataFrame]:
    """(rows, found): rows (row, doc_id, key) of every document, found (row, item_id, first, matched, compared).

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored. Null texts have no words. Items with
    equal texts count as the one with the smallest id. `first` is the word of the document, from 0, where the best
    window of an alignment begins.

    The items' seeds set the bits of a sieve of fixed size. One pass over the documents writes their row numbers,
    and of those with a seed that passes, the seeds and hashes of the words; seeds then meet in an equality join, which
    removes what the sieve let through wrongly, and only aligned stretches of words are compared.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    once = benchmark.filter(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item_id"))
    items, _ = scratch.save(_scanned(once, "item_id", seeds), "items")
    item_seeds, _ = scratch.save(
        items.select(F.col("row").alias("item_row"), F.inline("seeds")).withColumnRenamed("place", "item_place"), "item_seeds"
    )
    sieve = spark.sparkContext.broadcast(_sieve(item_seeds))  # 2^26 bits
    # fewer than `window` rows: documents are looked through only for the lengths that short items have
    size = F.size("words").alias("n")
    lengths = sorted(r.n for r in items.select(size).filter((F.col("n") > 0) & (F.col("n") < seeds.window)).distinct().collect())
    scanned, _ = scratch.save(_scanned(docs, "doc_id", seeds, sieve, lengths), "scanned")
    sieve.destroy()
    hits = scanned.filter(F.size("seeds") > 0).select("row", F.inline("seeds"))
    aligned = hits.join(item_seeds, "seed").select("row", "item_row", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    ours = items.select(F.col("row").alias("item_row"), F.col("id").alias("item_id"), F.col("words").alias("item_words"))
    theirs = scanned.filter(F.size("seeds") > 0).select("row", F.col("words").alias("doc_words"))
    # only the stretch where both have words moves on
    first = F.greatest(F.col("shift"), F.lit(0))
    skip = F.greatest(-F.col("shift"), F.lit(0))
    length = F.least(F.size("doc_words") - first, F.size("item_words") - skip)
    pairs = aligned.join(ours, "item_row").join(theirs, "row").select(
        "row",
        "item_id",
        first.cast("bigint").alias("first"),
        F.slice("doc_words", first + 1, length).alias("theirs"),
        F.slice("item_words", skip + 1, length).alias("ours"),
        F.size("item_words").alias("length"),
    )
    verified = pairs.mapInArrow(_verify(seeds), "row BIGINT, item_id BIGINT, first BIGINT, matched BIGINT, compared BIGINT")
    found, _ = scratch.save(verified, "found")
    return scanned.select("row", F.col("id").alias("doc_id"), "key"), found


def judge(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds()) -> DataFrame:
    """(doc_id, contaminated, item_ids, matched) of every row: items in order, most words of a window that agree."""
    rows, found = overlaps(docs, benchmark, seeds)
    one = found.groupBy("row", "item_id").agg(F.max("matched").alias("matched"))
    per_row = one.groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"), F.max("matched").alias("matched"))
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("matched", F.lit(0)).alias("matched"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds()) -> DataFrame:
    """`docs` without contaminated rows, in all columns.

    Rows with null ids are judged by their text alike, repeated rows go or stay together; null and empty texts stay.
    """
    rows, found = overlaps(docs, benchmark, seeds)
    bad = rows.join(found.select("row").distinct(), "row", "left_semi").select("key").distinct()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), row_key().alias("key"))
    return keyed.join(bad, "key", "left_anti").select("_doc.*")
