"""The damage that the conversation query deals out, and its result in SQL: one state per conversation, turn by turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns as a checksum of `conv_id:turn` has them: dropped, emptied, cut of stops, repeated or given to the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = conversations.withColumn("_dealt", dealt).filter(F.col("_dealt") != 0)
    text = (
        F.when(F.col("_dealt") == 1, "")
        .when(F.col("_dealt") == 2, F.regexp_replace(said("text"), "[.!?]", ""))
        .otherwise(said("text"))
    )
    times = F.when(F.col("_dealt") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_dealt") == 4, "user").otherwise(said("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"),
    ).drop("_copy")


def _plus(state: str, cost: str, edit: str) -> str:
    return f"lpad(CAST(CAST({state}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {state}[10:] || '{edit}'"


def _or(*states: str) -> str:
    return f"least({', '.join(states)})"


def _kept(state: str, role: str) -> str:
    """Keep what has the role, give it to others; NULL if the turn must go."""
    kept, turned = _plus(state, "extra", "K"), _plus(state, "extra + 1", "R")
    return f"CASE WHEN NOT gone THEN CASE WHEN ini = '{role}' THEN {kept} ELSE {turned} END END"


#: States are cost (nine digits) and audit, so that the least string is the cheapest and of these the first.
_OPEN = f"""(SELECT *, {_or('t2', _plus('t3', '5', 'I'))} AS i2, {_or('t3', _plus('t2', '5', 'I'))} AS i3 FROM (
   SELECT *, {_or('q2', *[_plus(q, '5', 'I') for q in ('q0', 'q1', 'q3')])} AS t2, {_or('q3', _plus('q2', '5', 'I'))} AS t3 FROM {{}}))"""

SQL = f"""WITH RECURSIVE
 tab AS (
  SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(b)),
 keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
 crc(s, i, c) AS (
  SELECT DISTINCT s, 1, CAST(4294967295 AS BIGINT) FROM keyed
  UNION ALL SELECT s, i + 1, xor(v, c >> 8) FROM crc JOIN tab ON b = xor(c & 255, CAST(ascii(s[i:i]) AS BIGINT)) WHERE i <= length(s)),
 dealt AS (SELECT s, xor(c, 4294967295) % 20 AS f FROM crc WHERE i = length(s) + 1),
 dam AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed JOIN dealt USING (s) WHERE f <> 0),
 ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM dam),
 judged AS (
  SELECT *, left(role, 1) AS ini, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) AS before FROM ordered),
 rows_ AS (
  SELECT *, blank OR again AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS extra FROM judged),
 counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
         count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows_ GROUP BY conv_id),
 dp(conv_id, i, q0, q1, q2, q3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM counts
  UNION ALL
  SELECT conv_id, pos, {_plus('q0', '2', 'D')},
         {_or(_plus('q1', '2', 'D'), f"CASE WHEN NOT gone AND ini = 's' THEN {_plus('q0', 'extra', 'K')} END")},
         {_or(_plus('i2', '2', 'D'), *[_kept(q, 'u') for q in ('q0', 'q1', 'i3')])},
         {_or(_plus('i3', '2', 'D'), _kept('i2', 'a'))}
  FROM (SELECT p.*, r.pos, r.ini, r.gone, r.extra FROM {_OPEN.format('dp')} p
        JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.i + 1)),
 ends AS (
  SELECT p.conv_id, {_or('q0', 'i3')} AS best FROM {_OPEN.format('dp')} p
  JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i),
 said AS (SELECT conv_id, CAST(best[1:9] AS BIGINT) AS cost, best[10:] AS audit FROM ends),
 redo(conv_id, audit, k, pos, last, n, acc) AS (
  SELECT conv_id, audit, 1, CAST(1 AS BIGINT), '', 0, '' FROM said
  UNION ALL
  SELECT conv_id, audit, k + 1, CASE WHEN e = 'I' THEN pos ELSE pos + 1 END, CASE WHEN e = 'D' THEN last ELSE left(role, 1) END,
         CASE WHEN e = 'D' THEN n ELSE n + 1 END,
         CASE WHEN e = 'D' THEN acc ELSE acc || CASE WHEN n > 0 THEN chr(10) ELSE '' END || role || ':' || CASE WHEN e = 'I' THEN '' ELSE text END END
  FROM (SELECT d.*, d.audit[d.k:d.k] AS e, r.text, CASE WHEN d.audit[d.k:d.k] = 'K' THEN r.role WHEN last = 'u' THEN 'assistant' ELSE 'user' END AS role
        FROM redo d LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.pos = d.pos WHERE d.k <= length(d.audit))),
 done AS (SELECT conv_id, audit, sha256(acc) AS repaired_sha256 FROM redo WHERE k = length(audit) + 1)
 SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s.cost, 0) AS cost, coalesce(s.audit, '') AS audit,
        coalesce(repaired_sha256, sha256('')) AS repaired_sha256
 FROM (SELECT DISTINCT conv_id FROM conversations) i
 LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM i.conv_id
 LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM i.conv_id"""
