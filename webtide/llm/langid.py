"""Language of documents by a linear-chain conditional random field over their words.

Every word has features: n-grams of its bytes with its edges, affixes, and the languages whose lexicon holds it. Their
weights and those of transitions from word to word are learned from code-switched sequences cut from labelled documents.
Forward-backward gives each word its probabilities; a document's language is the one with the largest mean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtide.llm.words import LETTERS, Words, mix, row_key, slices, split

UNKNOWN = "und"


@dataclass(frozen=True)
class Training:
    """Bounds of the sample and of the fit.

    languages: the labels with the most documents, ties by name; rarer ones are not learned. per_language: documents
    of each language in the sample, taken by hash of doc_id and text; chars: of longer ones so many characters are
    learned from, from the first letter on, so the sample has a fixed size. lexicon: most frequent words of each
    language, counted over all documents that may be learned from.
    """

    languages: int = 200
    per_language: int = 150
    chars: int = 20_000
    lexicon: int = 400
    steps: int = 120
    batch: int = 96
    length: int = 40
    rate: float = 0.15
    seed: int = 11


_BITS = 16
_NONE = 1 << _BITS  # row of zeros
#: Longest word in bytes. What is longer, as sentences of scripts without spaces are, is read in pieces.
_SPAN = 24
_BLOCK = 32


def features(w: Words, h: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rows of the weight table for each word, `_NONE` where there is nothing."""
    size = w.end - w.start
    place = np.arange(_SPAN)[None, :]
    inside = place < size[:, None]
    last = max(len(w.bytes) - 1, 0)
    raw = w.bytes[np.minimum(w.start[:, None] + place, last)] if len(w.bytes) else np.zeros((len(size), _SPAN), np.uint8)
    b = np.where(inside, raw, 0).astype(np.uint64) + np.uint64(1)
    # ^word$: zero-padded words end in their edge
    edged = np.concatenate([np.full((len(size), 1), 300, np.uint64), b, np.ones((len(size), 1), np.uint64)], axis=1)
    two = edged[:, :-1] * np.uint64(512) + edged[:, 1:]
    three = two[:, :-1] * np.uint64(512) + edged[:, 2:]
    grams = [
        np.where(place <= size[:, None], _row(two[:, :_SPAN], 1), _NONE),
        np.where(place < size[:, None], _row(three, 2), _NONE),
    ]
    tail = np.minimum(w.end[:, None] - 1 - np.arange(4)[None, :], last)
    ends = np.where(np.arange(4)[None, :] < size[:, None], w.bytes[np.maximum(tail, 0)] if len(w.bytes) else 0, 0).astype(np.uint64)
    power = np.uint64(257) ** np.arange(4, dtype=np.uint64)
    affixes = []
    for n in (2, 3, 4):
        enough = size >= n
        affixes.append(np.where(enough, _row((ends[:, :n] * power[:n]).sum(axis=1), 10 + n), _NONE))
        affixes.append(np.where(enough, _row((b[:, :n] * power[:n]).sum(axis=1), 20 + n), _NONE))
    words, held = lexicon
    at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
    known = (words[at] == h) if len(words) else np.zeros(len(h), bool)
    affixes.append(_row(np.where(known, held[at] if len(words) else 0, 0).astype(np.uint64), 30))
    affixes.append(np.where(known, _row(h, 31), _NONE))
    return np.concatenate([*grams, np.stack(affixes, axis=1)], axis=1).astype(np.int32)


def _row(value: np.ndarray, kind: int) -> np.ndarray:
    return (mix(value * np.uint64(64) + np.uint64(kind)) >> np.uint64(64 - _BITS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (2^16 + 1, languages)
    transitions: np.ndarray
    start: np.ndarray
    lexicon: tuple[np.ndarray, np.ndarray]

    def emissions(self, w: Words, h: np.ndarray) -> np.ndarray:
        out = np.empty((len(h), len(self.languages)), np.float32)
        for at in range(0, len(h), 50_000):
            part = slice(at, at + 50_000)
            rows = features(Words(w.bytes, w.start[part], w.end[part], w.at), h[part], self.lexicon)
            total = np.zeros((len(rows), len(self.languages)), np.float32)
            for column in rows.T:
                total += self.weights[column]
            out[part] = total
        return out


def _softmax_rows(x: np.ndarray) -> np.ndarray:
    return np.exp(x - x.max(axis=-1, keepdims=True))


def posteriors(model: Model, scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Probabilities of each word's language: forward-backward in every text (words at[i] to at[i + 1]).

    Texts are cut into blocks. A block is first one matrix, the product of its words' steps; vectors then run over
    the blocks of each text, and from there into all blocks at once. The result is that of word-by-word recursion.
    """
    n_words, k = scores.shape
    size = np.diff(at)
    per_text = -(-size // _BLOCK)
    n = int(per_text.sum())
    if not n or not k:
        return np.zeros((n_words, k))
    first_block = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    number = np.arange(n) - np.repeat(first_block, per_text)
    begin = np.repeat(at[:-1], per_text) + number * _BLOCK
    length = np.minimum(_BLOCK, np.repeat(at[1:], per_text) - begin)
    step = _softmax_rows(scores.astype(np.float64))
    move = np.exp(model.transitions - model.transitions.max())
    enter = np.exp(model.start - model.start.max())
    head = number == 0

    def word(t: int) -> tuple[np.ndarray, np.ndarray]:
        return t < length, step[np.minimum(begin + t, n_words - 1)]

    product = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(int(length.max())):
        on, e = word(t)
        moved = (product.reshape(-1, k) @ move).reshape(n, k, k)
        if t == 0:  # a text's first word comes from nowhere
            moved[head] = enter
        moved *= e[:, None, :]
        moved /= moved.max(axis=(1, 2), keepdims=True)
        product = np.where(on[:, None, None], moved, product)

    forward, backward = np.full((n, k), 1.0 / k), np.ones((n, k))
    unit = lambda x: x / x.sum(axis=1, keepdims=True)
    for b in range(1, int(per_text.max())):
        i = first_block[per_text > b] + b
        forward[i] = unit(np.einsum("nk,nkl->nl", forward[i - 1], product[i - 1]))
    for b in range(int(per_text.max()) - 2, -1, -1):
        i = first_block[per_text > b + 1] + b
        backward[i] = unit(np.einsum("nkl,nl->nk", product[i + 1], backward[i + 1]))

    out = np.zeros((n_words, k))
    ahead = np.empty((_BLOCK, n, k))
    now = forward
    for t in range(int(length.max())):
        on, e = word(t)
        moved = now @ move
        if t == 0:
            moved[head] = enter
        now = np.where(on[:, None], unit(moved * e), now)
        ahead[t] = now
    now = backward
    for t in range(int(length.max()) - 1, -1, -1):
        on, e = word(t)
        both = unit(ahead[t][on] * now[on])
        out[begin[on] + t] = both
        now = np.where(on[:, None], unit((now * e) @ move.T), now)
    return out


def pieces(w: Words) -> Words:
    """The same bytes in words of at most `_SPAN`: longer ones are cut between characters, evenly but for those."""
    step = _SPAN - 3  # a cut moves back by up to three bytes
    size = w.end - w.start
    n = np.where(size > _SPAN, -(-size // step), 1)
    ends = np.cumsum(n)
    word = np.repeat(np.arange(len(n)), n)
    start = w.start[word] + (np.arange(len(word)) - np.repeat(ends - n, n)) * step
    for _ in range(3):
        start = start - ((w.bytes[start] & 0xC0) == 0x80)
    end = np.append(start[1:], 0)[: len(start)]
    end[ends - 1] = w.end
    return Words(w.bytes, start, end, np.concatenate([[0], ends])[w.at])


def letters_only(w: Words) -> Words:
    """Words that have a letter, in pieces: those without an ASCII letter are looked at as text."""
    ascii_before = np.concatenate([[0], np.cumsum(w.bytes < 128)])
    plain = ascii_before[w.end] > ascii_before[w.start]
    keep = plain.copy()
    for i in np.flatnonzero(~plain).tolist():
        word = w.bytes[w.start[i] : w.end[i]].tobytes().decode("utf-8", "replace")
        keep[i] = any(c.isalpha() for c in word)
    before = np.concatenate([[0], np.cumsum(keep)])
    return pieces(Words(w.bytes, w.start[keep], w.end[keep], before[w.at]))


def _read(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Words that have a letter, and their hashes. Read in slices: numbers per byte are held for one slice only."""
    parts, hashed, n = [], [np.zeros(0, np.uint64)], 0
    for lo, hi in slices(texts):
        w = letters_only(split(texts[lo:hi], LETTERS))
        hashed.append(w.hashes())
        parts.append((w.bytes, w.start + n, w.end + n, np.diff(w.at)))
        n += len(w.bytes)
    kinds = (np.uint8, np.int64, np.int64, np.int64)
    columns = [np.concatenate([np.zeros(0, kind), *(p[i] for p in parts)]) for i, kind in enumerate(kinds)]
    return Words(*columns[:3], np.concatenate([[0], np.cumsum(columns[3])])), np.concatenate(hashed)


def fit(
    texts: list[str], labels: list[str], settings: Training = Training(), frequent: dict[str, list[int]] | None = None
) -> Model:
    """Model from labelled texts: averaged gradients of the likelihood of code-switched sequences, AdaGrad steps.

    Texts without words teach nothing; a label that has no others is not among the languages. `frequent` has the hashes
    of each language's lexicon; without it the most frequent words of these texts are taken.
    """
    rng = np.random.default_rng(settings.seed)
    w, h = _read(pa.array(texts, pa.string()))
    worded = np.flatnonzero(np.diff(w.at) > 0).tolist()
    if len(worded) < len(texts):
        return fit([texts[i] for i in worded], [labels[i] for i in worded], settings, frequent)
    languages = sorted(set(labels))
    k = len(languages)
    label = np.array([languages.index(x) for x in labels], np.int64)

    # a word's mark stands for the set of languages whose lexicons hold it
    one = mix(np.arange(1, k + 1, dtype=np.uint64)).tolist()
    held: dict[int, int] = {}
    of = np.repeat(label, np.diff(w.at)) if frequent is None else None
    for i in range(k):
        if frequent is None:
            word, n = np.unique(h[of == i], return_counts=True)
            most = word[np.argsort(-n, kind="stable")[: settings.lexicon]].tolist()
        else:
            most = frequent.get(languages[i], [])
        for x in most:
            held[x] = (held.get(x, 0) + one[i]) % (1 << 64)
    words = np.array(sorted(held), np.uint64)
    lexicon = (words, np.array([held[x] for x in words.tolist()], np.uint64))
    model = Model(languages, np.zeros((_NONE + 1, k), np.float32), np.zeros((k, k)), np.zeros(k), lexicon)
    if k < 2:
        return model
    filled = [np.flatnonzero(label == i) for i in range(k)]

    size, t_max = settings.batch, settings.length
    g_w, g_t, g_s = np.full_like(model.weights, 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    for _ in range(settings.steps):
        pick, truth = _sequences(rng, filled, w.at, size, t_max)
        # features of the words picked for this step only: those of all words would be many times the texts
        unique, first, back = np.unique(h[pick], return_index=True, return_inverse=True)
        picked = pick.reshape(-1)[first]
        rows = features(Words(w.bytes, w.start[picked], w.end[picked], w.at), unique, lexicon)[back.reshape(pick.shape)]  # (batch, length, features)
        scores = np.zeros((size, t_max, k), np.float32)
        for i in range(rows.shape[2]):
            scores += model.weights[rows[..., i]]
        scores = scores.astype(np.float64)
        flat = scores.reshape(-1, k)
        at = np.arange(0, size * t_max + 1, t_max)
        gamma = posteriors(model, flat, at).reshape(size, t_max, k)
        pair = _pairs(model, scores)
        wrong = gamma.copy()
        np.put_along_axis(wrong, truth[..., None], np.take_along_axis(wrong, truth[..., None], 2) - 1, 2)
        seen = np.zeros((k, k))
        np.add.at(seen, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
        index = rows.reshape(-1)
        grad = np.stack(
            [np.bincount(index, np.repeat(wrong[..., i].ravel(), rows.shape[2]), _NONE + 1) for i in range(k)], axis=1
        ) / size
        grad[_NONE] = 0
        for value, g, past in ((model.weights, grad.astype(np.float32), g_w), (model.transitions, (pair - seen) / size, g_t), (model.start, wrong[:, 0].sum(axis=0) / size, g_s)):
            past += g * g
            value -= (settings.rate * g / np.sqrt(past)).astype(value.dtype)
    return model


def _sequences(rng: np.random.Generator, filled: list[np.ndarray], at: np.ndarray, size: int, length: int):
    """Places of words and their labels: runs of 3 to 40 words from random documents, one language after another."""
    pick, truth = np.zeros((size, length), np.int64), np.zeros((size, length), np.int64)
    for row in range(size):
        t = 0
        while t < length:
            language = int(rng.integers(len(filled)))
            doc = int(filled[language][rng.integers(len(filled[language]))])
            run = min(int(rng.integers(3, 41)), length - t, int(at[doc + 1] - at[doc]))
            begin = int(at[doc]) + int(rng.integers(at[doc + 1] - at[doc] - run + 1))
            pick[row, t : t + run], truth[row, t : t + run] = np.arange(begin, begin + run), language
            t += run
    return pick, truth


def _pairs(model: Model, scores: np.ndarray) -> np.ndarray:
    """Expected numbers of transitions over a batch of sequences of one length."""
    n, length, k = scores.shape
    step = _softmax_rows(scores)
    move = np.exp(model.transitions - model.transitions.max())
    unit = lambda x: x / x.sum(axis=1, keepdims=True)
    ahead = np.empty((length, n, k))
    ahead[0] = unit(np.exp(model.start - model.start.max()) * step[:, 0])
    for t in range(1, length):
        ahead[t] = unit((ahead[t - 1] @ move) * step[:, t])
    back, total = np.ones((n, k)), np.zeros((k, k))
    for t in range(length - 1, 0, -1):
        after = step[:, t] * back
        both = ahead[t - 1][:, :, None] * move * after[:, None, :]
        total += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = unit(after @ move.T)
    return total


def _predict(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                w = letters_only(split(batch.column("text")[lo:hi], LETTERS))
                h = w.hashes()
                unique, first, back = np.unique(h, return_index=True, return_inverse=True)
                scores = model.emissions(Words(w.bytes, w.start[first], w.end[first], w.at), unique)
                total = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(posteriors(model, scores[back], w.at), axis=0)])
                n = np.diff(w.at)
                mean = (total[w.at[1:]] - total[w.at[:-1]]) / np.maximum(n, 1)[:, None]
                best = np.where(n > 0, mean.argmax(axis=1), len(model.languages)) if len(model.languages) else np.zeros(hi - lo, int)
                score = np.where(n > 0, mean.max(axis=1, initial=0.0), 0.0).clip(0.0, 1.0)
                columns = [batch.column("doc_id")[lo:hi], batch.column("key")[lo:hi], pa.array(names[best].tolist(), pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "lang_pred", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _teachers(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang) of documents that may be learned from: labelled, with letters, not held out."""
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    return docs.filter(usable & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")


def sample(docs: DataFrame, settings: Training) -> tuple[list[str], list[str]]:
    """Texts and labels to learn from, at most `per_language` of each of the `languages` with the most documents.

    Documents are counted per language by doc_id and text, so that a row repeated very often is one; a hash threshold
    then keeps a few times the wanted number, and of these the least hashes stay; only their texts come to the driver. So
    no window or collection grows with the corpus, whatever ids repeat and however many labels there are.
    """
    rows = _teachers(docs)
    turn = F.xxhash64("doc_id", "text")
    per = rows.groupBy("lang").agg(F.approx_count_distinct(turn).alias("n"))
    counts = {r["lang"]: r["n"] for r in per.orderBy(F.desc("n"), "lang").limit(settings.languages).collect()}
    if not counts:
        return [], []
    low = -(1 << 63)
    wide = {x: min((1 << 63) - 1, low + (3 * settings.per_language << 64) // max(n, 1)) for x, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for pair in wide.items() for x in pair])
    few = rows.withColumn("turn", turn).filter(F.col("lang").isin(*counts) & (F.col("turn") <= F.element_at(limit, F.col("lang"))))
    passage = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{settings.chars - 1}}}", 0)
    short = F.when(F.length("text") <= settings.chars, F.col("text")).otherwise(passage)
    once = few.groupBy("lang", "turn").agg(F.min(short).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("turn"))
    taken = once.withColumn("place", place).filter(F.col("place") <= settings.per_language)
    got = taken.select("lang", "turn", "text").orderBy("lang", "turn").collect()
    return [r["text"] for r in got], [r["lang"] for r in got]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of the words in each slice of texts."""
    for batch in batches:
        for lo, hi in slices(batch.column("text")):
            w = letters_only(split(batch.column("text")[lo:hi], LETTERS))
            labels = batch.column("lang")[lo:hi].dictionary_encode()
            of = np.repeat(labels.indices.to_numpy(), np.diff(w.at))
            h = w.hashes()
            # by language, then by word
            order = np.lexsort((h, of))
            h, of = h[order], of[order]
            first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1]))) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(h)))
            names = labels.dictionary.take(pa.array(of[first]))
            columns = [names, pa.array(h[first].view(np.int64)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])


def lexicons(docs: DataFrame, languages: list[str], size: int) -> dict[str, list[int]]:
    """Hashes of the `size` most frequent words of each language over all documents that may be learned from, ties by hash.

    Words are counted per slice and per task before the shuffle, and each task ranks its own before `size` words per
    language meet.
    """
    if not languages or size < 1:
        return {}
    rows = _teachers(docs).filter(F.col("lang").isin(*languages)).select("lang", "text")
    counted = rows.mapInArrow(_word_counts, "lang STRING, word BIGINT, n BIGINT").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    out: dict[str, list[int]] = {x: [] for x in languages}
    for r in counted.withColumn("place", place).filter(F.col("place") <= size).collect():
        out[r["lang"]].append(r["word"] % (1 << 64))
    return out


def learn(docs: DataFrame, settings: Training = Training()) -> Model:
    texts, labels = sample(docs, settings)
    return fit(texts, labels, settings, lexicons(docs, sorted(set(labels)), settings.lexicon))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, key, lang_pred, score) of every whole text of `docs` (doc_id, text; others are ignored).

    score is the mean probability of the language over the words, 0 to 1. A null text or one without letters is
    `und` with score 0, and so is every text if there was nothing to learn from. Repeated rows are judged alike. `key`
    is a hash of doc_id and text. The model has a fixed size for a given number of languages.
    """
    return _predicted(docs, docs.sparkSession.sparkContext.broadcast(model))


def _predicted(docs: DataFrame, shared) -> DataFrame:
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("key"), text.alias("text"))
    return rows.mapInArrow(_predict(shared), "doc_id BIGINT, key BINARY, lang_pred STRING, score DOUBLE")


def accepted(docs: DataFrame, model: Model, least: float = 0.35) -> DataFrame:
    """`docs` in one known language, in all columns: those that are `und` or score under `least` go.

    Null texts and texts without letters are `und`; repeated rows go or stay together.
    """
    from webtide.plans.lineage import Scratch

    shared = docs.sparkSession.sparkContext.broadcast(model)
    found, _ = Scratch(docs.sparkSession).save(_predicted(docs, shared), "languages")
    shared.destroy()
    bad = found.filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least)).select("key").distinct()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), row_key().alias("key"))
    return keyed.join(bad, "key", "left_anti").select("_doc.*")
