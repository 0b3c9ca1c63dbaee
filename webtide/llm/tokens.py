"""Token ids of documents in ORC files: written in document order, read stripe by stripe, pruned by metadata.

Files: `<path>/data` holds one row per document (doc_id, part, local_start, n_tokens, ids); `ids` are integers
under ORC's run-length encoding, `doc_id` has row indexes and a Bloom filter in every stripe. `<path>/parts` has
one row per data file (part, first and last doc_id, n_docs, n_tokens, base): the ids of all files before it. A
document starts at base + local_start, so no running total ever crosses a task.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webtide.llm.words import kept

END_ID = 2
_DATA = "doc_id BIGINT, part INT, local_start BIGINT, n_tokens BIGINT, ids ARRAY<INT>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.int32()),
        ("local_start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)
#: Bytes of text encoded at a time; words that a worker remembers, and bytes of them.
_SLICE, _CACHE, _CACHE_BYTES = 4 << 20, 1 << 18, 16 << 20
#: Bytes of words that go through the model together.
_TOGETHER = 256
_IDS = pa.list_(pa.int32())
#: Kinds of bytes: the edge of a text, blanks, ends of lines, letters, digits, marks, and all else.
_EDGE, _BLANK, _LINE, _LETTER, _DIGIT, _MARK, _ELSE = range(7)
_KIND = np.full(256, _ELSE, np.uint8)
_KIND[33:127] = _MARK
_KIND[ord("'")] = _ELSE
_KIND[ord(" ")], _KIND[ord("\n")], _KIND[ord("0") : ord("9") + 1] = _BLANK, _LINE, _DIGIT
_KIND[ord("A") : ord("Z") + 1] = _KIND[ord("a") : ord("z") + 1] = _LETTER
# U+00C0 to U+023F in UTF-8; two of them are no letters. A character that begins with another byte is of kind _ELSE
_KIND[0x80:0xC0] = _KIND[0xC3:0xC9] = _LETTER
_NO_LETTERS = (0x97, 0xB7)
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u023f"
#: One word of the pre-tokenizer, if nothing of kind _ELSE is in it.
_WORD = rf"^(?: ?(?:[{_LATIN}]+|[0-9]+|[!-&(-/:-@\[-`{{-~]+)|\n+)$"
#: Bytes of white space beyond ASCII (Unicode's).
_WHITE = np.array([int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])


def _lists(ends: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    """Lists that lie one after another in `values` and stop at `ends`."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, pa.int32()))


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _parts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where strings (large ones, none null) begin and end in their bytes, and these."""
    _, offsets, data = strings.buffers()
    edge = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(data, np.uint8)[edge[0] : edge[-1]] if data is not None else np.zeros(0, np.uint8)
    return edge - edge[0], raw


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts one after another, each with the space in front of it, and where each text's words begin.

    Texts are cut at spaces that no white space follows, and pieces without a character of kind _ELSE or another space
    as the pre-tokenizer cuts: where the kind changes, and in front of the last of several ends of lines that
    something follows.
    """
    edge, raw = _parts(texts)
    kind = _KIND[raw]
    odd = np.flatnonzero(raw[:-1] == 0xC3)
    kind[odd[np.isin(raw[odd + 1], _NO_LETTERS)]] = _ELSE
    after = np.full_like(kind, _EDGE)
    after[:-1] = kind[1:]
    after[edge[1:][edge[1:] > 0] - 1] = _EDGE
    blank = np.flatnonzero(kind == _BLANK)
    unclear = blank[after[blank] == _ELSE]
    one, two, three = (raw[np.minimum(unclear + i, len(raw) - 1)].astype(np.int64) for i in (1, 2, 3))
    white = (one < 32) | np.isin(one << 8 | two, _WHITE) | np.isin(one << 16 | two << 8 | three, _WHITE)
    kind[np.concatenate([blank[after[blank] <= _LINE], unclear[white]])] = _ELSE
    before = np.full_like(kind, _EDGE)
    before[1:] = kind[:-1]
    before[edge[:-1][edge[:-1] < len(raw)]] = _EDGE
    starts = (kind == _BLANK) | ((kind != before) & (before != _BLANK)) | ((kind == _LINE) & (after >= _LETTER))
    start, others = np.flatnonzero(starts), np.flatnonzero(kind == _ELSE)
    if len(others):
        first = (kind[start] == _BLANK) | (before[start] == _EDGE)
        uncut = np.zeros(np.count_nonzero(first), bool)
        uncut[np.searchsorted(start[first], others, "right") - 1] = True
        start = start[first | ~uncut[np.cumsum(first) - 1]]
    ends = pa.py_buffer(np.append(start, len(raw)).astype(np.int64))
    return pa.LargeStringArray.from_buffers(len(start), ends, pa.py_buffer(raw)), np.searchsorted(start, edge)


class _Known:
    """Ids of strings, worked out when first asked for. Of too many, at most `_CACHE` of those asked for last stay."""

    def __init__(self, ids_of: Callable[[pa.Array], pa.ListArray]) -> None:
        self.ids_of, self.keys, self.ids = ids_of, pa.array([], pa.large_string()), pa.array([], _IDS)

    def __len__(self) -> int:
        return len(self.keys)

    def of(self, asked: pa.Array) -> pa.ListArray:
        """Ids of each of the strings, which are distinct."""
        at = pc.index_in(asked, value_set=self.keys)
        new = asked.filter(at.is_null())
        ids = pa.concat_arrays([self.ids, self.ids_of(new)]) if len(new) else self.ids
        place = at.fill_null(-1).to_numpy().copy()
        place[place < 0] = len(self.keys) + np.arange(len(new))
        found = ids.take(pa.array(place))
        if len(ids) > _CACHE or self.keys.nbytes + new.nbytes > _CACHE_BYTES:
            stay = pa.array(np.arange(min(len(asked), _CACHE)))
            self.keys, self.ids = asked.take(stay), found.take(stay)
        elif len(new):
            self.keys, self.ids = pa.concat_arrays([self.keys, new]), ids
        return found


class Encoder:
    """Ids of whole texts by the tokenizers library, which works out each distinct word once.

    A byte-level BPE never joins across a space that a non-space follows, nor across words of its pre-tokenizer, so
    the ids of the words (see `_words`), one after another, are the ids of the text. Distinct words go through the
    model some at a time, with a byte between that no token has beside others. Texts with an added token of the
    tokenizer are encoded in one go. How many words are remembered changes time, not results.
    """

    def __init__(self, tokenizer: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self._whole = Tokenizer.from_str(tokenizer.decode())
        if self._whole.normalizer is not None or not isinstance(self._whole.pre_tokenizer, ByteLevel):
            raise ValueError("a byte-level BPE without normalizer is needed")
        self._cut, self._model = self._whole.pre_tokenizer.pre_tokenize_str, self._whole.model.tokenize
        self._added = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self._forms = np.zeros(256, "<u4")
        self._forms[shown] = shown
        self._forms[self._forms == 0] = 256 + np.arange(256 - len(shown))
        # UTF-8 has no byte 255, so tokens have it alone, if at all
        self._between = self._whole.token_to_id("\xff")
        alone = sum("\xff" in token for token in self._whole.get_vocab(with_added_tokens=False)) == 1
        self._together = _TOGETHER if alone and self._between is not None else 1
        self._after_space = _Known(self._ids)

    def _word_ids(self, words: pa.Array) -> pa.ListArray:
        """Ids of the pre-tokenizer's words."""
        edge, raw = _parts(words)
        forms = self._forms[np.insert(raw, edge[1:], 255)].tobytes().decode("utf-32-le")
        ends = edge[1:] + np.arange(len(words))
        last = np.append(np.flatnonzero(np.diff(ends // self._together)), len(words) - 1)
        ids, begin, between = [], 0, self._between if self._together > 1 else -1
        for stop in ends[last].tolist():
            ids += [t.id for t in self._model(forms[begin:stop])]
            ids.append(between)
            begin = stop + 1
        flat = np.array(ids, np.int32)
        return _lists(np.flatnonzero(flat == between) - np.arange(len(words)), flat[flat != between])

    def _ids(self, pieces: pa.Array) -> pa.ListArray:
        """Ids of words, or of pieces that the pre-tokenizer still has to cut."""
        single = pc.match_substring_regex(pieces, _WORD)
        words, ends = [], []
        for piece in _strings(pieces.filter(pc.invert(single))):
            words += [piece[a:b] for _, (a, b) in self._cut(piece)]
            ends.append(len(words))
        ids = self._word_ids(pa.concat_arrays([pa.array(words, pa.large_string()), pieces.filter(single)]))
        ends = np.concatenate([ends, len(words) + np.arange(1, len(pieces) - len(ends) + 1)]).astype(np.int64)
        is_single = single.to_numpy(zero_copy_only=False)
        place = np.where(is_single, np.count_nonzero(~is_single) + np.cumsum(is_single), np.cumsum(~is_single)) - 1
        return _lists(ids.offsets.to_numpy()[ends], ids.flatten()).take(pa.array(place))

    def lists(self, texts: pa.Array, end: list[int]) -> pa.ListArray:
        """Ids of each text (a null one: none), then `end`."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words, at = _words(texts)
        coded = words.dictionary_encode()
        index, n = coded.indices.to_numpy().astype(np.int64), np.diff(at)
        whole = np.zeros(len(texts), bool)
        for token in self._added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        one_go = [self._whole.encode(t, add_special_tokens=False).ids for t in _strings(texts.filter(pa.array(whole)))]
        if one_go:
            # the first word stands for the text
            stays = np.repeat(~whole, n)
            stays[at[:-1][whole]] = True
            index[at[:-1][whole]] = len(coded.dictionary) + np.arange(len(one_go))
            index, n = index[stays], np.where(whole, 1, n)
        stops = np.cumsum(n)
        pool = pa.concat_arrays([self._after_space.of(coded.dictionary), pa.array(one_go, _IDS), pa.array([end], _IDS)])
        ids = pool.take(pa.array(np.insert(index, stops, len(pool) - 1)))
        return _lists(ids.offsets.to_numpy()[stops + np.arange(1, len(stops) + 1)], ids.flatten())

    def __call__(self, text: str) -> bytes:
        """Unsigned 32-bit ids of the text, least byte first."""
        return self.lists(pa.array([text]), []).flatten().to_numpy().astype("<i4").tobytes()


def _encoder(tokenizer: bytes) -> Encoder:
    """One per Python worker; its memory of pieces lasts over tasks, until another operator keeps something there."""
    return kept(("encoder", tokenizer), lambda: Encoder(tokenizer))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    size, start = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size and size + n > _SLICE:
            yield start, i
            size, start = 0, i
        size += n
    if start < len(texts):
        yield start, len(texts)


def _encode(tokenizer: bytes, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_id, text = batch.column("doc_id"), batch.column("text")
            for lo, hi in _slices(text):
                lists = encode.lists(text[lo:hi], [end_id])
                ends = lists.offsets.to_numpy().astype(np.int64)
                n = np.diff(ends)
                columns = [doc_id[lo:hi], pa.array(np.full(hi - lo, part, np.int32)), pa.array(start + ends[:-1]), pa.array(n), lists]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)
                start += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, stripe_mb: int = 16, stride: int = 1000
) -> None:
    """Encode `docs` (doc_id, text; others are ignored) and write `<path>/data` and `<path>/parts`.

    `tokenizer` is the path of a tokenizers file; its content (a fixed size) travels with the tasks, so it need
    not exist on executors. Every whole text is encoded, a null one as an empty one, and `end_id` follows it.
    Rows go by (doc_id, text), a null doc_id first; repeated rows are kept. An empty table gives empty files.
    One pass over the texts: a range shuffle by doc_id (texts tell apart equal ids, so these can be split too),
    a sort within tasks, encoding in batches of a few MB, and ORC files whose order is the order of the ids.
    """
    with open(tokenizer, "rb") as f:
        encode = _encode(f.read(), end_id)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tied = rows.withColumn("tie", F.xxhash64("text"))
    ordered = tied.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    (
        ordered.mapInArrow(encode, _DATA)
        .write.format("orc")
        .option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", str(stripe_mb << 20))
        .option("orc.row.index.stride", str(stride))
        .mode("overwrite")
        .save(f"{path}/data")
    )
    spark = docs.sparkSession
    sizes = (
        spark.read.schema(_DATA)
        .orc(f"{path}/data")
        .groupBy("part")
        .agg(
            F.min("doc_id").alias("first_doc_id"),
            F.max("doc_id").alias("last_doc_id"),
            F.count(F.lit(1)).alias("n_docs"),
            F.sum("n_tokens").alias("n_tokens"),
        )
    )
    # one row per data file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = sizes.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint"))
    based.write.mode("overwrite").orc(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; tasks read ranges of stripes, a filter on doc_id prunes them."""
    data = spark.read.schema(_DATA).orc(f"{path}/data")
    parts = spark.read.schema("part INT, base BIGINT").orc(f"{path}/parts")
    # one row per data file
    placed = data.join(F.broadcast(parts), "part")
    return placed.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        ids = batch.column("ids")
        flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
        at = ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        columns = [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what `read_tokens` gives: counts and sums of the ids themselves."""
    return tokens.mapInArrow(_checksums, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
