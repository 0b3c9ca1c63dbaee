"""Substring dedup by words: passages that an earlier document holds as well are removed, found by anchors.

Places 1, 2 and 4 modulo 7 form a difference cover: whatever the distance of two texts, some place among any seven
in a row is of the cover in both. Runs of `ANCHOR` = 7 words are hashed at cover places only, so two texts that share
`WINDOW` = 13 words share an anchor that both have hashed. Around anchors that occur in several documents the match is
extended: every window of 13 words that holds one is compared as a whole, by its 128-bit key. Groups of equal windows meet as the
smallest doc_id of each, never as pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtide.llm.words import mix
from webtide.plans.lineage import Scratch

PERIOD, COVER, ANCHOR, WINDOW = 7, (1, 2, 4), 7, 13
#: Bits of the sieve of shared anchors, a fixed size; with more than one anchor in `_FULL` bits they are joined instead.
_SIEVE_BITS, _FULL = 27, 8
#: Bytes of text worked on at a time; a longer text is worked on alone.
_SLICE = 1 << 20
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: Two bases of byte hashes, two of word sequences; odd, so that their powers have inverses.
_BYTES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORDS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, mod 2^64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def _ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A hash of values[start:end] for each range, from one running sum."""
    power, back = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:-1], out=total[1:])
    return mix((total[end] - total[start]) * back[start])


class _Texts:
    """Some texts cut into words: `raw` bytes, words from `start` to `end`, text i has words at[i] to at[i + 1]."""

    def __init__(self, texts: pa.Array) -> None:
        _, offsets, data = texts.buffers()
        edge = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.raw = np.frombuffer(data, np.uint8)[edge[0] : edge[-1]] if data is not None else np.zeros(0, np.uint8)
        edge = edge - edge[0]
        word = ~_SPACE[self.raw]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        # words end where their text ends
        inner = edge[1:-1]
        inner = inner[(inner > 0) & (inner < len(word))]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.at = np.searchsorted(self.start, edge)
        self.count = np.diff(self.at)

    def hashes(self, which: int) -> np.ndarray:
        return _ranges(self.raw.astype(np.uint64) + np.uint64(1), self.start, self.end, _BYTES[which])

    def runs(self, hashes: np.ndarray, first: np.ndarray, words: int, which: int) -> np.ndarray:
        """A hash of the `words` words from each of `first` on."""
        return _ranges(hashes, first, first + words, _WORDS[which])

    def of(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, place in it) of every word."""
        text = np.repeat(np.arange(len(self.count)), self.count)
        return text, np.arange(len(self.start)) - self.at[text]

    def anchors(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of every run of `ANCHOR` words that begins at a cover place."""
        text, place = self.of()
        word = np.flatnonzero(np.isin(place % PERIOD, COVER) & (place + ANCHOR <= self.count[text]))
        return word, self.runs(hashes, word, ANCHOR, 0)

    def windows_around(self, words: np.ndarray) -> np.ndarray:
        """First words of all windows that hold one of these anchors."""
        text, place = self.of()
        open_ = np.zeros(len(self.start) + 1, np.int64)
        low = np.maximum(words - (WINDOW - ANCHOR), self.at[text[words]])
        np.add.at(open_, low, 1)
        np.add.at(open_, words + 1, -1)
        return np.flatnonzero((np.cumsum(open_[:-1]) > 0) & (place + WINDOW <= self.count[text]))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, _Texts]]:
    """Parts of the batches of about `_SLICE` bytes of text (the last column), with their words."""
    for batch in batches:
        text = batch.column(batch.num_columns - 1).cast(pa.large_string()).fill_null("")
        edge = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + _SLICE, "right")) - 1)
            yield batch.slice(lo, hi - lo), _Texts(text[lo:hi])
            lo = hi


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, docs): each anchor once per slice; docs is 2 if several of its texts have it."""
    for _, t in _sliced(batches):
        word, h = t.anchors(t.hashes(0))
        order = np.argsort(h, kind="stable")
        h, text = h[order], t.of()[0][word[order]]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        begin = np.flatnonzero(new)
        # equal anchors come in the order of their texts
        last = np.append(begin[1:], len(h)) - 1
        docs = 1 + (text[begin] != text[last[: len(begin)]])
        yield pa.RecordBatch.from_arrays([pa.array(h[begin].view(np.int64)), pa.array(docs.astype(np.int64))], names=["h", "docs"])


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, rid, place) of every anchor of every text."""
    for batch, t in _sliced(batches):
        word, h = t.anchors(t.hashes(0))
        text, place = t.of()
        rid = batch.column(0).to_numpy()[text[word]]
        columns = [pa.array(h.view(np.int64)), pa.array(rid), pa.array(place[word].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["h", "rid", "place"])


def _bits(h: np.ndarray) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)


def _block(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - _SIEVE_BITS + 16)


def _sieve_of(spark: SparkSession, shared: DataFrame) -> np.ndarray:
    """A bit for every shared anchor: 2^27 in all, put together in blocks of 8 KB by the tasks."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            bit = _bits(batch.column(0).to_numpy())
            for b in np.unique(bit >> 16).tolist():
                made.setdefault(b, np.zeros(1 << 16, bool))[bit[bit >> 16 == b] & 0xFFFF] = True
        names = pa.array(list(made), pa.int64())
        yield pa.RecordBatch.from_arrays([names, pa.array([np.packbits(v).tobytes() for v in made.values()], pa.binary())], names=["b", "bits"])

    # at most 2^11 blocks, each built in one task
    dealt = shared.select("h").repartition(_block(F.col("h")))
    sieve = np.zeros(1 << (_SIEVE_BITS - 3), np.uint8)
    for r in dealt.mapInArrow(blocks, "b BIGINT, bits BINARY").collect():
        sieve[r.b << 13 : (r.b + 1) << 13] = np.frombuffer(r.bits, np.uint8)
    return sieve


def _kept_anchors(sieve) -> Callable[[pa.RecordBatch, _Texts, np.ndarray], np.ndarray]:
    """Words where an anchor begins that passes the sieve, or that is listed with its text (column places)."""

    def kept(batch: pa.RecordBatch, t: _Texts, hashes: np.ndarray) -> np.ndarray:
        if sieve is not None:
            word, h = t.anchors(hashes)
            bit = _bits(h)
            return word[(sieve.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)]
        listed = batch.column("places")
        size = np.diff(listed.offsets.to_numpy())
        return np.repeat(t.at[:-1], size) + listed.flatten().to_numpy()

    return kept


def _window_rows(sieve, with_places: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows around kept anchors: (k1, k2, low, high) once per slice, or (k1, k2, doc_id, rid, place) each."""
    kept = _kept_anchors(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in _sliced(batches):
            one = t.hashes(0)
            first = t.windows_around(kept(batch, t, one))
            if not len(first):
                continue
            k1 = t.runs(one, first, WINDOW, 0).view(np.int64)
            k2 = t.runs(t.hashes(1), first, WINDOW, 1).view(np.int64)
            text, place = t.of()
            doc_id = batch.column("doc_id").to_numpy()[text[first]]
            if with_places:
                rid = batch.column("rid").to_numpy()[text[first]]
                columns = [k1, k2, doc_id, rid, place[first].astype(np.int32)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["k1", "k2", "doc_id", "rid", "place"])
                continue
            order = np.lexsort((doc_id, k2, k1))
            k1, k2, doc_id = k1[order], k2[order], doc_id[order]
            new = np.ones(len(k1), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(k1)) - 1
            columns = [k1[begin], k2[begin], doc_id[begin], doc_id[last]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["k1", "k2", "low", "high"])

    return run


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Every write below leaves a table; what it shuffled goes when it is done."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _text_key() -> Column:
    """128 bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(_text(), 256)), 1, 16)


def earlier_windows(docs: DataFrame, sieve_for: int = (1 << _SIEVE_BITS) // _FULL) -> DataFrame:
    """(key, first, starts) of every distinct text of a document that has a doc_id, written; `first` is the smallest.

    `starts` are the first words, ascending, of all windows of 13 words that a document with a smaller doc_id than
    `first` has too, null if there is none. Of equal texts only the first document is looked at, which is all
    that others can repeat. Up to `sieve_for` shared anchors are looked up in a sieve of fixed size, whose false
    passes only make windows that meet nobody; more are joined. The results are the same.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    with _shuffles_freed(spark):
        named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text().alias("text"), _text_key().alias("key"))
        groups = named.filter(F.col("doc_id").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("first"))
        texts, _ = scratch.save(groups, "texts")
        # joined by doc_id as well, so that a group of copies is spread
        at = texts.withColumnsRenamed({"first": "doc_id"})
        chosen = named.join(at, ["key", "doc_id"], "left_semi").withColumn("rid", F.monotonically_increasing_id())
        ours, _ = scratch.save(chosen.select("rid", "doc_id", "key", "text"), "chosen")

        counted = ours.select("text").mapInArrow(_anchor_rows, "h BIGINT, docs BIGINT")
        several = counted.groupBy("h").agg(F.sum("docs").alias("docs")).filter(F.col("docs") > 1)
        shared, seen = scratch.save(several.select("h"), "anchors")

        source, sieve = ours.select("rid", "doc_id", "text"), None
        if seen["rows"] <= sieve_for:
            sieve = spark.sparkContext.broadcast(_sieve_of(spark, shared))  # 2^27 bits
        else:
            places = ours.select("rid", "text").mapInArrow(_positions, "h BIGINT, rid BIGINT, place INT")
            met = places.join(shared, "h", "left_semi").groupBy("rid").agg(F.array_sort(F.collect_list("place")).alias("places"))
            source, _ = scratch.save(ours.join(met, "rid").select("rid", "doc_id", "places", "text"), "placed")

        ends = source.mapInArrow(_window_rows(sieve, False), "k1 BIGINT, k2 BIGINT, low BIGINT, high BIGINT")
        groups = ends.groupBy("k1", "k2").agg(F.min("low").alias("least"), F.max("high").alias("most"))
        repeated, _ = scratch.save(groups.filter(F.col("least") < F.col("most")).select("k1", "k2", "least"), "repeated")

        each = source.mapInArrow(_window_rows(sieve, True), "k1 BIGINT, k2 BIGINT, doc_id BIGINT, rid BIGINT, place INT")
        later = each.join(repeated, ["k1", "k2"]).filter(F.col("doc_id") > F.col("least"))
        starts = later.groupBy("rid").agg(F.array_sort(F.collect_list("place")).alias("starts"))
        # repeated rows of one document say the same
        by_key = starts.join(ours.select("rid", "key"), "rid").groupBy("key").agg(F.min("starts").alias("starts"))
        # a table of its own, so that the texts' join with it is a plain one, whose hot groups of copies can be split
        answers, _ = scratch.save(texts.join(by_key, "key", "left"), "answers")
    if sieve is not None:
        sieve.destroy()
    return answers


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, `copy`, `starts`, text -> doc_id, n_words, removed spans, kept text."""
    for batch, t in _sliced(batches):
        copy, listed = batch.column("copy").to_numpy(zero_copy_only=False), batch.column("starts")
        size = np.diff(listed.offsets.to_numpy())
        open_ = np.zeros(len(t.start) + 1, np.int64)
        first = np.repeat(t.at[:-1], size) + listed.flatten().to_numpy()
        whole = copy & (t.count >= WINDOW)
        first = np.concatenate([first, t.at[:-1][whole]])
        last = np.concatenate([first[: len(first) - whole.sum()] + WINDOW, t.at[1:][whole]])
        np.add.at(open_, first, 1)
        np.add.at(open_, last, -1)
        gone = np.cumsum(open_[:-1]) > 0
        before = np.zeros(len(gone), bool)
        before[1:] = gone[:-1]
        inner = t.at[:-1][t.count > 0]
        before[inner] = False
        after = np.zeros(len(gone), bool)
        after[:-1] = gone[1:]
        after[inner[1:] - 1] = False
        span_from, span_to = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
        owner = np.searchsorted(t.at, span_from, "right") - 1
        ends = np.searchsorted(owner, np.arange(len(t.count) + 1))
        spans = pa.StructArray.from_arrays([pa.array(span_from - t.at[owner]), pa.array(span_to - t.at[owner])], names=["start", "end"])
        # kept words move to where they follow each other with one space between
        keep = ~gone
        raw = t.raw.tobytes()
        kept = [
            b" ".join([raw[a:b] for a, b in zip(t.start[lo:hi][keep[lo:hi]].tolist(), t.end[lo:hi][keep[lo:hi]].tolist())])
            for lo, hi in zip(t.at[:-1].tolist(), t.at[1:].tolist())
        ]
        columns = [
            batch.column("doc_id"),
            pa.array(t.count.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "removed", "text"])


def without_copies(docs: DataFrame, sieve_for: int = (1 << _SIEVE_BITS) // _FULL) -> DataFrame:
    """(doc_id, n_words, removed, text) of every row of `docs` (doc_id, text; others are ignored).

    A word is removed if a window of 13 words that holds it also begins in a document with a smaller doc_id; `removed`
    are the maximal spans of such words (from, to before), `text` the others with one space between. All windows are judged on
    `docs` as they are. Null texts have no words. Rows without doc_id neither lose words nor take any from others; rows
    with one doc_id, equal or not, take nothing from each other. An empty table gives no rows.
    """
    answers = earlier_windows(docs, sieve_for)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text().alias("text"), _text_key().alias("key"))
    joined = rows.join(answers, "key", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    mine = F.when(F.col("doc_id") == F.col("first"), F.col("starts"))
    ready = joined.select("doc_id", copy.alias("copy"), F.coalesce(mine, F.array().cast("array<int>")).alias("starts"), "text")
    return ready.mapInArrow(_removed, "doc_id BIGINT, n_words BIGINT, removed ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, text STRING")
