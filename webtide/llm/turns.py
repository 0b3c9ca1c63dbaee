"""Conversations put back into alternating order at the least cost, each with an audit of what was done.

The roles of a repaired conversation are an optional system turn and then user and assistant in turn, or it has no
turn at all. Its turns are aligned (Wagner and Fischer) to every length of that pattern that the cost of the best
alignment so far leaves open. All patterns are ends of the longest one, so one table holds them: entry (i, r) is the
cost of turns from i on against the last r roles. Rows of the table only reach as far from its diagonal as that cost allows
(Ukkonen's bands). Of the cheapest alignments of all lengths the one whose audit comes first counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webtide.plans.lineage import Scratch

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A turn is one byte: its role's initial, and 4 if it is truncated or 8 if it must go.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
_CUT, _GONE = 4, 8
_ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Conversations with more turns are aligned by the state of the pattern, see `by_states`.
LONG = 4096
_CACHE = 20_000
_FAR = 1 << 29


def align(turns: bytes) -> tuple[int, str]:
    """(cost, audit) of one conversation: K keep, R another role, D delete, I insert; of equal costs the first audit."""
    codes = np.frombuffer(turns, np.uint8)
    best = _some_cost(codes)
    floor = DELETE * int(np.count_nonzero(codes & _GONE))
    if len(codes) > LONG:
        return by_states(turns)
    # a narrow band first: a cost that it reaches is right if the band is as wide as that cost asks for
    limit = floor + 8
    while True:
        found = _aligned(codes, min(limit, best))
        if found is not None or limit >= best:
            return found
        limit = floor + 2 * (limit - floor)


def _some_cost(codes: np.ndarray) -> int:
    """Cost of keeping what is whole, with roles in turn: any alignment does as a first bound."""
    whole = codes[codes < _CUT]
    even = len(whole) - len(whole) % 2
    turned = int(np.count_nonzero(whole[:even] != np.resize([USER, ASSISTANT], even)))
    return REROLE * turned + DELETE * (len(codes) - even)


def _aligned(codes: np.ndarray, limit: int) -> tuple[int, str] | None:
    """The cheapest alignment over all lengths, if its cost is `limit` or less."""
    n, gone = len(codes), codes & _GONE > 0
    slack = limit - DELETE * int(gone.sum())
    below, above = slack // DELETE, slack // INSERT
    width = below + above + 1
    # turns that may stay, from i on; a row holds r from stay[i] - below to stay[i] + above
    stay = np.append(np.cumsum(~gone[::-1])[::-1], 0)
    role, extra = codes & 3, np.where(codes & _CUT, TRUNCATED, 0)
    step = INSERT * np.arange(width)
    table = np.full((n + 1, width + 1), _FAR, np.int32)
    r = np.arange(width) - below
    table[n, :width] = np.where(r >= 0, INSERT * r, _FAR)
    for i in range(n - 1, -1, -1):
        later, row = table[i + 1], table[i]
        if gone[i]:
            row[:width] = later[:width] + DELETE
            continue
        r = np.arange(width) + (stay[i] - below)
        wrong = role[i] != np.where(r % 2, ASSISTANT, USER)
        cost = np.minimum(later[1:] + DELETE, later[:width] + np.where(r > 0, extra[i] + wrong * REROLE, _FAR))
        cost = np.minimum.accumulate(np.where(r < 0, _FAR, cost) - step) + step
        row[:width] = np.minimum(cost, _FAR)

    def at(i: int, r: int) -> int:
        x = r - int(stay[i]) + below
        return int(table[i, x]) if 0 <= x < width else _FAR

    lengths = [r for r in range(max(0, int(stay[0]) - below), int(stay[0]) + above + 1) if r % 2 == 0]
    # a system turn is kept first: those before it go
    lead = np.flatnonzero(codes < _GONE)
    lead = [int(i) for i in lead if role[i] == SYSTEM and DELETE * i <= limit]
    totals = {(r, -1): at(0, r) for r in lengths}
    totals |= {(r, i): DELETE * i + int(extra[i]) + at(i + 1, r) for i in lead for r in range(2, int(stay[i + 1]) + above + 1, 2)}
    cost = min(totals.values(), default=_FAR)
    if cost > limit:
        return None
    return cost, min(_audit(codes, extra, at, r, first) for (r, first), c in totals.items() if c == cost)


def _audit(codes: np.ndarray, extra: np.ndarray, at, r: int, first: int) -> str:
    """Traced back from the beginning; of steps that cost the same in the end, the first by name."""
    out, i = ["D" * first + "K" if first >= 0 else ""], first + 1
    n = len(codes)
    while i < n or r:
        here = at(i, r)
        if i < n and at(i + 1, r) + DELETE == here:
            out.append("D")
            i += 1
        elif r and at(i, r - 1) + INSERT == here:
            out.append("I")
            r -= 1
        else:
            out.append("K" if codes[i] & 3 == (ASSISTANT if r % 2 else USER) else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def by_states(turns: bytes) -> tuple[int, str]:
    """The same for conversations of any length, in one pass each way and 16 bytes a turn.

    The least cost over all lengths of the pattern only depends on what the last kept or inserted turn was: nothing, the
    system turn, user or assistant.
    """
    n, follow = len(turns), (2, 2, 3, 2)  # what is inserted after each
    to_end = np.zeros((n + 1, 4), np.int32)
    last = [0, 2 * INSERT, INSERT, 0]
    to_end[n] = last
    for i in range(n - 1, -1, -1):
        code = turns[i]
        now = [x + DELETE for x in last]
        if code < _GONE:
            role, cost = code & 3, TRUNCATED if code & _CUT else 0
            to_user = last[2] + cost + (role != USER)
            now = [min(now[0], to_user), min(now[1], to_user), min(now[2], last[3] + cost + (role != ASSISTANT)), min(now[3], to_user)]
            if role == SYSTEM:
                now[0] = min(now[0], last[1] + cost)
        for _ in range(2):
            now = [min(x, now[follow[q]] + INSERT) for q, x in enumerate(now)]
        to_end[i] = last = now
    out, i, q = [], 0, 0
    while True:
        here, code = int(to_end[i][q]), turns[i] if i < n else _GONE
        if i == n and q in (0, 3) and here == 0:
            return int(to_end[0][0]), "".join(out)
        if i < n and to_end[i + 1][q] + DELETE == here:
            out.append("D")
            i += 1
        elif to_end[i][follow[q]] + INSERT == here:
            out.append("I")
            q = follow[q]
        else:
            role, cost = code & 3, TRUNCATED if code & _CUT else 0
            want = ASSISTANT if q == 2 else USER
            if role == SYSTEM and q == 0 and to_end[i + 1][1] + cost == here:
                out.append("K")
                q = 1
            else:
                out.append("K" if role == want else "R")
                q = 3 if q == 2 else 2
            i += 1


# --- what Spark does ----------------------------------------------------------------------------------

_ORDER = ["turn", "role", "tie"]
_AUDITS = (
    "conv_id {}, n_turns BIGINT, gaps BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, "
    "cost BIGINT, audit STRING"
)


def _told(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, tie (a hash of the text), text; null roles and texts are one space."""
    filled = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    return filled.withColumn("tie", F.unhex(F.sha2("text", 256)))


def _faults(told: DataFrame) -> DataFrame:
    """One narrow row per turn, or per several equal ones: code without and with what repeats, and how many."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    code = role + F.when(blank, 2 * _GONE).when(whole, 0).otherwise(_CUT)
    key = ["conv_id", "turn", "role", "tie"]
    equal = told.withColumn("code", code).groupBy(*key).agg(F.min("code").alias("code"), F.count(F.lit(1)).alias("n"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "tie").orderBy("turn"))
    return equal.withColumn("first", seen == 1)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn -> one row per conversation."""
    known: dict[bytes, tuple[int, str]] = {}
    out: list[list] = []
    ids: list[pa.Array] = []
    codes, turns, spans, faults = bytearray(), 0, [None, None], [0, 0, 0]
    kind, previous = None, _NONE

    def close() -> None:
        nonlocal codes, turns, spans, faults
        key = bytes(codes)
        if key not in known:
            if len(known) >= _CACHE:
                known.clear()
            known[key] = align(key)
        cost, audit = known[key]
        role = np.frombuffer(key, np.uint8) & 3
        legal = np.isin(role[:-1] * 4 + role[1:], [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
        low, high = spans
        gaps = high - low + 1 - turns if turns else 0
        out.append([previous, len(key), gaps, *faults, int(np.count_nonzero(~legal)), cost, audit])
        codes, turns, spans, faults = bytearray(), 0, [None, None], [0, 0, 0]

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 9
        types = [kind, *[pa.int64()] * 7, pa.string()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)
        out.clear()
        return made

    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, turn, code, n, first in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "code", "n", "first")]):
            if conv != previous:
                if previous is not _NONE:
                    close()
                    if len(out) >= 1000:
                        yield flush()
                previous = conv
            if turn is not None and turn != spans[1]:
                spans, turns = [turn if spans[0] is None else spans[0], turn], turns + 1
            if code >= 2 * _GONE:
                faults[0] += n
                codes += bytes([code - _GONE]) * n
                continue
            again = n - 1 if first else n
            faults[1] += again
            faults[2] += (n - again) * (code >= _CUT)
            codes += bytes([code]) * (n - again) + bytes([(code & 3) + _GONE]) * again
    if previous is not _NONE:
        close()
        yield flush()


_NONE = object()
_NAMES = [f.split()[0] for f in _AUDITS.split(", ")]


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (conv_id, turn, role, text; others are ignored), null being one of them.

    n_turns, gaps (turn numbers that are missing between the least and the largest), blank, duplicate and truncated
    turns (the first that holds of each; a duplicate has role and text of an earlier turn), illegal (neighbours that
    are neither system and user nor user and assistant in either order), cost and audit of the repair. Turns go by
    number, a null one first, then by role and by a hash of the text. Null roles and texts are one space. Only roles, numbers and
    hashes are shuffled; equal turns are counted before. A conversation is its audit: a byte per turn in one task.
    """
    kind = dict(rows.dtypes)["conv_id"]
    marked = _faults(_told(rows))
    dealt = marked.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return dealt.select("conv_id", "turn", "code", "n", "first").mapInArrow(_conversations, _AUDITS.format(kind))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An audit, then the turns it is about, in order -> what is left of them."""
    audit, at, place, last = "", 0, 0, OTHER
    for batch in batches:
        taken: list[int] = []
        made: list[tuple] = []

        def insert(conv) -> None:
            nonlocal at, place, last
            last = ASSISTANT if last == USER else USER
            taken.append(conv)
            made.append((place, None, "I", _ROLES[last], ""))
            at, place = at + 1, place + 1

        columns = [batch.column(c).to_pylist() for c in ("audit", "turn", "role", "text")]
        for i, (told, turn, role, text) in enumerate(zip(*columns)):
            if told is not None:
                audit, at, place, last = told, 0, 0, OTHER
            else:
                edit = audit[at]
                at += 1
                if edit != "D":
                    if edit == "R":
                        role = "assistant" if last == USER else "user"
                    last = {"u": USER, "a": ASSISTANT}.get(role[:1], OTHER)
                    taken.append(i)
                    made.append((place, turn, edit, role, text))
                    place += 1
            # what is put in before the next turn, or at the end
            while at < len(audit) and audit[at] == "I":
                insert(i)
        if made:
            place_, turn_, edit_, role_, text_ = zip(*made)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(pa.array(taken)),
                    pa.array(place_, pa.int64()),
                    pa.array(turn_, pa.int64()),
                    pa.array(edit_, pa.string()),
                    pa.array(role_, pa.string()),
                    pa.array(text_, pa.string()),
                ],
                names=["conv_id", "place", "turn", "edit", "role", "text"],
            )


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, turns): `audits` as above, written; turns (conv_id, place, turn, edit, role, text) after the repair.

    Turns of a conversation come together and in order within a partition; inserted ones have no number and an empty text.
    They pass through a task one by one, whatever the length of their conversation. An empty table gives none.
    """
    made, _ = Scratch(rows.sparkSession).save(audits(rows), "audits")
    none = lambda kind: F.lit(None).cast(kind)
    heads = made.select(
        "conv_id", F.lit(0).alias("kind"), none("bigint").alias("turn"), none("string").alias("role"),
        none("binary").alias("tie"), none("string").alias("text"), "audit",
    )
    told = _told(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "tie", "text", none("string").alias("audit"))
    dealt = heads.unionByName(told).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
    kind = dict(rows.dtypes)["conv_id"]
    shape = f"conv_id {kind}, place BIGINT, turn BIGINT, edit STRING, role STRING, text STRING"
    return made, dealt.mapInArrow(_apply, shape)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    previous, running, kind = _NONE, hashlib.sha256(), None
    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for conv, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
            if place == 0:
                if previous is not _NONE:
                    done.append((previous, running.hexdigest()))
                previous, running = conv, hashlib.sha256()
            running.update(("\n" if place else "").encode() + f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([h for _, h in done], pa.string())], names=["conv_id", "sha256"])
    if previous is not _NONE:
        yield pa.RecordBatch.from_arrays([pa.array([previous], kind), pa.array([running.hexdigest()])], names=["conv_id", "sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of `role:text` lines of the turns that `repair` gives, which come in order."""
    kind = dict(turns.dtypes)["conv_id"]
    return turns.select("conv_id", "place", "role", "text").mapInArrow(_hashed, f"conv_id {kind}, sha256 STRING")
