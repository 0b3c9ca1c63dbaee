"""Repairs against all edit scripts, the two ways of aligning against each other, and the query against its SQL."""

import hashlib
import random
import re
import zlib
from itertools import product

import duckdb
import pytest

from webtide.llm import queries, turns, turns_sql

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def brute_align(codes):
    """Cheapest script by a shortest path over everything: (turns read, last role), cost, audit."""
    import heapq

    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(codes) and last in ("", "a"):
            return cost, audit
        follow = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, audit + "I", i, follow))
        if i < len(codes):
            role, cut, gone = "sua-"[codes[i] & 3], codes[i] & 4, codes[i] & 8
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last))
            if not gone:
                extra = 5 if cut else 0
                if role == follow or (role == "s" and last == ""):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role))
                if role != follow:
                    heapq.heappush(heap, (cost + extra + 1, audit + "R", i + 1, follow))


def test_all_short_conversations():
    for n in range(5):
        for codes in product((0, 1, 2, 3, 5, 6, 4, 9, 10), repeat=n):
            want = brute_align(codes)
            assert turns.align(bytes(codes)) == want, codes
            assert turns.by_states(bytes(codes)) == want, codes


@pytest.mark.parametrize("seed", range(3))
def test_long_conversations(seed, monkeypatch):
    rng = random.Random(seed)
    for n in (20, 50, 300, 1000):
        regular = [1 + k % 2 for k in range(n)]
        codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 9, 10]) if rng.random() < (0.1, 0.4, 1.0)[seed] else c for c in regular)
        assert turns.align(codes) == turns.by_states(codes)
    alone = turns.align(codes)
    monkeypatch.setattr(turns, "LONG", 10)
    assert turns.align(codes) == alone


def brute(rows):
    """{conv_id: counts, cost, audit, repaired lines} of damaged turns (conv_id, turn, role, text)."""
    groups = {}
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, said in groups.items():
        said.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha(x[2])))
        seen, codes, faults = set(), [], [0, 0, 0]
        for _, role, text in said:
            bare = text.strip(" \t\n\v\f\r")
            code = "sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3
            if not bare:
                faults[0], code = faults[0] + 1, code + 8
            elif (role, text) in seen:
                faults[1], code = faults[1] + 1, code + 8
            elif bare[-1] not in ".!?":
                faults[2], code = faults[2] + 1, code + 4
            seen.add((role, text))
            codes.append(code)
        numbers = {t for t, _, _ in said if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit = brute_align(codes)
        lines, at = [], 0
        for e in audit:
            role = "assistant" if lines and lines[-1][0] == "u" else "user"
            if e == "I":
                lines.append(f"{role}:")
                continue
            if e != "D":
                lines.append(f"{said[at][1] if e == 'K' else role}:{said[at][2]}")
            at += 1
        assert GRAMMAR.match("".join(x[0] for x in lines))
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, n):
    rng = random.Random(seed)
    texts = ["Hello.", "What is it?", "cut off", "", " \t", "Hello.", None, "Ends so! \n", "déjà vu.", "x"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    return [(rng.choice([1, 2, 3, 4, 5, None]), rng.choice([None, 0, 1, 2, 3, 4, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def to_df(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS cost", "2 AS kind", "'x' AS audit").repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_repair(spark, seed):
    rows = random_rows(seed, 70)
    audits, repaired = turns.repair(to_df(spark, rows))
    want = brute(rows)
    got = {r.conv_id: r for r in audits.collect()}
    hashed = {r.conv_id: r.sha256 for r in turns.digests(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert set(got) == set(want) and set(hashed) <= set(want)
    for conv, w in want.items():
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashed.get(conv, empty)) == w


def test_empty_table_and_long_conversation(spark, monkeypatch):
    audits, repaired = turns.repair(to_df(spark, []))
    assert audits.collect() == [] and repaired.collect() == [] and turns.digests(repaired).collect() == []
    rng = random.Random(2)
    rows = [(1, k, rng.choice(["user", "assistant"]), f"{k}" * rng.randint(1, 3) + rng.choice(["", ".", "."])) for k in range(5000)]
    rows += [(1, 7, "user", "same.")] * 3000
    audits, repaired = turns.repair(to_df(spark, rows))
    r = audits.first()
    assert r.n_turns == 8000 and r.duplicate >= 2999
    w = brute(rows)[1]
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == w[:-1]
    assert turns.digests(repaired).first().sha256 == w[-1]


def damage(rows):
    """The damage by its definition."""
    out = []
    for conv, turn, role, text in rows:
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        out += [(conv, turn, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return out


@pytest.mark.parametrize("name", ["sf0.001", "odd"])
def test_the_query(spark, tmp_path, name):
    if name == "odd":
        sf_dir = str(tmp_path)
        rows = [(c, t, r, x) for c, t, r, x in random_rows(9, 200)] + [(c, 0, "user", "a.") for c in range(100, 160)]
        to_df(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{sf_dir}/conversations.parquet")
        files = f"{sf_dir}/conversations.parquet/*.parquet"
    else:
        sf_dir = f"/root/testdata/{name}"
        files = f"{sf_dir}/conversations.parquet"
        rows = [tuple(r) for r in queries.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    df = queries.queries()["op11_turn_repair"](spark, sf_dir)
    columns = df.columns
    got = sorted(repr(tuple(r)) for r in df.collect())
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = brute(damage(rows))
    assert got == sorted(repr((c, *want.get(c, nothing))) for c in {r[0] for r in rows})
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{files}'")
    said = con.execute(f"SELECT {', '.join(columns)} FROM ({turns_sql.SQL})").fetchall()
    assert sorted(map(repr, said)) == got
