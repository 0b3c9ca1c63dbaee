"""Words of many texts at once, as hashes, with numpy over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text worked on at a time; a longer text is worked on alone.
SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)

_letters = np.zeros(256, bool)
_letters[ord("a") : ord("z") + 1] = True
_letters[128:] = True
#: Bytes of words in lowered UTF-8: letters and whatever is not ASCII, with or without digits.
LETTERS = _letters
WORDS = _letters | np.isin(np.arange(256), np.arange(ord("0"), ord("9") + 1))

_kept: dict = {}


def kept(name, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: one thing, so that a stage does not hold what the one before needed."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, mod 2^64."""
    powers = kept("powers", lambda: [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    if len(powers[0]) < n:
        made = []
        for b in (_BASE, _BACK):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        if n > SLICE + 1:
            return made  # for one very long text
        powers[:] = made
    return powers


def row_key() -> Column:
    """Tells rows apart by doc_id and text: 128 bits of SHA-256, so that no two documents ever share one."""
    doc_id = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("-"))
    text = F.coalesce(F.concat(F.lit("t"), F.col("text").cast("string")), F.lit(""))
    return F.substring(F.unhex(F.sha2(F.concat(doc_id, F.lit(":"), text), 256)), 1, 16)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """`bytes` of all texts; words from `start` to `end`; text i has words at[i] to at[i + 1]."""

    bytes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        power, back = _power(len(self.bytes) + 1)
        total = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power[: len(self.bytes)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * back[self.start])


def split(texts: pa.Array, kind: np.ndarray) -> Words:
    """Maximal runs of `kind` bytes in each lowered text; nulls are empty."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    _, offsets, data = low.buffers()
    edge = np.frombuffer(offsets, np.int64)[low.offset : low.offset + len(low) + 1] if len(low) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[edge[0] : edge[-1]] if data is not None else np.zeros(0, np.uint8)
    edge = edge - edge[0]
    inside = kind[raw]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    # words end where their text ends
    before[edge[:-1][edge[:-1] < len(raw)]] = False
    after[edge[1:][edge[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return Words(raw, start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, edge))


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to `SLICE` bytes together."""
    size, start = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size and size + n > SLICE:
            yield start, i
            size, start = 0, i
        size += n
    if start < len(texts):
        yield start, len(texts)
