"""Versioned tables of a corpus, state and chunks, in hash buckets that a version touches one by one.

State has a row per page, by `url`; chunks are the bulk, by `source`. Both lie in directories by the hash of that key. A
version writes what it changed into the buckets it is about: changed rows of state, chunks added, keys of chunks
removed. Its manifest (one file, created only if there is none yet) lists the parts that make up every bucket, so a
reader with keys in hand opens their buckets and nothing else, and never sees half a version. Of two publishers at once one gets
`PublishConflict` and can decide again on the new state.

A bucket with too many parts is rewritten by the version that makes it so; parts and manifests that none of the last
versions needs are removed after that. A store's size, its manifest's and the cost of reading it are therefore bounded by its
content, not by the number of versions.
"""

from __future__ import annotations

import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtide.operators.sync import STATE_SCHEMA
from webtide.plans.lineage import create_file, delete_path, names_in, read_file

CHUNK_SCHEMA = (
    "source string, chunk_ix int, text string, chunk_sha string, url string, session_id string"
)
_REMOVED_SCHEMA = "source string, chunk_sha string"
_VERSION = r"^([0-9]+)-"
_KINDS = {"state": (STATE_SCHEMA, "url"), "added": (CHUNK_SCHEMA, "source"), "removed": (_REMOVED_SCHEMA, "source")}
#: miss_count of a row that says its page is no longer known.
_GONE = -1
#: Ids of published sessions and batches that are remembered, the latest ones.
_REMEMBERED = 1000


class PublishConflict(RuntimeError):
    """Somebody else has published this version meanwhile."""


@dataclass
class Manifest:
    """What a version consists of: kind -> bucket -> parts, oldest first; `size` is the number of buckets of each part."""

    version: int = 0
    buckets: int = 0
    sessions: list[str] = field(default_factory=list)
    parts: dict[str, dict[str, list[str]]] = field(default_factory=lambda: {k: {} for k in _KINDS})
    size: dict[str, dict[str, int]] = field(default_factory=lambda: {k: {} for k in _KINDS})

    def of(self, kind: str, buckets: list[int] | None = None) -> dict[str, list[str]]:
        held = self.parts[kind]
        return held if buckets is None else {str(b): held[str(b)] for b in buckets if str(b) in held}


class CorpusStore:
    """`buckets` counts for a new store only; an old one keeps its own. A bucket is to be one task's work: without a number
    there are as many as a shuffle has partitions.

    `most_parts` is how many parts a bucket may have before it is rewritten, `keep` how many versions before the last
    stay readable.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, most_parts: int = 8, keep: int = 2) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.most_parts, self.keep = most_parts, keep

    # --- what is there --------------------------------------------------------------------------------

    def _manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            version = max((int(n[:-5]) for n in names_in(self.spark, f"{self.path}/published") if n.endswith(".json")), default=0)
        if not version:
            return Manifest(buckets=self._buckets)
        return Manifest(**json.loads(read_file(self.spark, f"{self.path}/published/{version}.json")))

    def version(self) -> int:
        return self._manifest().version

    def has_session(self, session_id: str) -> bool:
        return session_id in self._manifest().sessions

    def _bucket(self, key: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _buckets_of(self, keys: DataFrame, buckets: int) -> list[int]:
        """Buckets that hold these keys: at most as many numbers as the store has buckets."""
        key = keys.columns[0]
        return [r.b for r in keys.select(self._bucket(key, buckets).alias("b")).distinct().collect()]

    def read_state(self, urls: DataFrame | None = None) -> DataFrame:
        """The newest row of every page, or of those in `urls` (one column), for which only their buckets are read."""
        m = self._manifest()
        rows = self._state(m, None if urls is None else self._buckets_of(urls, m.buckets))
        return rows if urls is None else _only(rows, "url", urls)

    def read_chunks(self, sources: DataFrame | None = None) -> DataFrame:
        """Chunks that were added and not removed in a later version; with `sources` (one column) only theirs."""
        m = self._manifest()
        rows = self._chunks(m, None if sources is None else self._buckets_of(sources, m.buckets))
        return rows if sources is None else _only(rows, "source", sources)

    def _state(self, m: Manifest, buckets: list[int] | None) -> DataFrame:
        held = m.of("state", buckets)
        alone = self._read(m, "state", {b: p for b, p in held.items() if len(p) == 1}).drop("_v")
        several = {b: p for b, p in held.items() if len(p) > 1}
        if several:
            rows = self._read(m, "state", several)
            rest = [c for c in rows.columns if c not in ("url", "_v")]
            newest = rows.groupBy("url").agg(F.max_by(F.struct(*rest), "_v").alias("s")).select("url", "s.*")
            alone = alone.unionByName(newest)
        return alone.filter(F.coalesce("miss_count", F.lit(0)) != _GONE)

    def _chunks(self, m: Manifest, buckets: list[int] | None) -> DataFrame:
        held, gone = m.of("added", buckets), m.of("removed", buckets)
        rows = self._read(m, "added", {b: p for b, p in held.items() if b not in gone}).drop("_v")
        lessened = {b: p for b, p in held.items() if b in gone}
        if not lessened:
            return rows
        added = self._read(m, "added", lessened)
        until = self._read(m, "removed", gone).groupBy("source", "chunk_sha").agg(F.max("_v").alias("_until"))
        same = (
            (added["source"] == until["source"])
            & (added["chunk_sha"] == until["chunk_sha"])
            & (added["_v"] < until["_until"])
        )
        return rows.unionByName(added.join(until, same, "left_anti").drop("_v"))

    def _read(self, m: Manifest, kind: str, held: dict[str, list[str]]) -> DataFrame:
        """These parts of these buckets as one scan; `_v` is a row's version."""
        schema, _ = _KINDS[kind]
        of_part: dict[str, list[str]] = {}
        for bucket, parts in held.items():
            for part in parts:
                of_part.setdefault(part, []).append(bucket)
        # a part that is read in all its buckets is one path
        paths = [
            p
            for part, buckets in of_part.items()
            for p in (
                [f"{self.path}/{kind}/part={part}"]
                if len(buckets) == m.size[kind][part]
                else [f"{self.path}/{kind}/part={part}/bucket={b}" for b in buckets]
            )
        ]
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, _v int")
        reader = self.spark.read.schema(f"{schema}, part string, bucket int").option("basePath", f"{self.path}/{kind}")
        version = F.regexp_extract("part", _VERSION, 1).cast("int")
        return reader.parquet(*paths).withColumn("_v", version).drop("part", "bucket")

    # --- versions -------------------------------------------------------------------------------------

    def publish(
        self,
        state: DataFrame,
        added: DataFrame,
        removed: DataFrame | None = None,
        session_id: str = "",
        base: bool = False,
        whole_state: bool = True,
        forgotten: DataFrame | None = None,
    ) -> int:
        """Write the next version; what was begun and not finished stays invisible.

        With whole_state=False, `state` holds only the rows that changed, and `forgotten` (url) the pages that are no longer
        known. With base=True, `added` are all chunks there are. Raises `PublishConflict` if another publisher was
        faster; its own parts are removed then.
        """
        m = self._manifest()
        v, part = m.version + 1, f"{m.version + 1}-{uuid.uuid4().hex[:12]}"
        m.version, m.sessions = v, [*m.sessions, session_id][-_REMEMBERED:] if session_id else m.sessions
        if forgotten is not None:
            nothing = [F.lit(None).cast(kind).alias(c) for c, kind in state.dtypes if c not in ("url", "miss_count")]
            state = state.unionByName(forgotten.select("url", F.lit(_GONE).alias("miss_count"), *nothing))
        every = range(m.buckets)
        writes = [("state", state, every if whole_state else ()), ("added", added, every if base else ())]
        if base:
            m.parts["removed"] = {}
        elif removed is not None:
            writes.append(("removed", removed, ()))
        # three tables that do not depend on each other
        with ThreadPoolExecutor(len(writes)) as pool:
            for done in [pool.submit(self._add, m, kind, rows, part, replaced) for kind, rows, replaced in writes]:
                done.result()
        self._rewrite_crowded(m, f"{part}c")
        m.size = {k: {p: n for p, n in m.size[k].items() if any(p in held for held in m.parts[k].values())} for k in _KINDS}
        if not create_file(self.spark, f"{self.path}/published/{v}.json", json.dumps(asdict(m))):
            for kind in _KINDS:
                for own in (part, f"{part}c"):
                    delete_path(self.spark, f"{self.path}/{kind}/part={own}")
            raise PublishConflict(f"version {v} has been published by somebody else")
        self._sweep(v)
        return v

    def _add(self, m: Manifest, kind: str, rows: DataFrame, part: str, replaced) -> None:
        """Write rows into the buckets of their keys; `replaced` buckets hold nothing else from then on."""
        schema, key = _KINDS[kind]
        columns = [f.split()[0] for f in schema.split(", ")]
        place = f"{self.path}/{kind}/part={part}"
        # few rows are few files, and a bucket with very many rows is several
        dealt = rows.select(*columns, self._bucket(key, m.buckets).alias("bucket")).hint("rebalance", F.col("bucket"))
        dealt.write.partitionBy("bucket").parquet(place)
        wrote = [n.split("=")[1] for n in names_in(self.spark, place) if n.startswith("bucket=")]
        for b in replaced:
            m.parts[kind].pop(str(b), None)
        for b in wrote:
            m.parts[kind].setdefault(b, []).append(part)
        m.size[kind][part] = len(wrote)

    def _rewrite_crowded(self, m: Manifest, part: str) -> None:
        """Buckets with too many parts become one part each."""
        crowded = [int(b) for b, p in m.parts["state"].items() if len(p) > self.most_parts]
        if crowded:
            self._add(m, "state", self._state(m, crowded), part, crowded)
        crowded = {int(b) for kind in ("added", "removed") for b, p in m.parts[kind].items() if len(p) > self.most_parts}
        if crowded:
            self._add(m, "added", self._chunks(m, sorted(crowded)), part, crowded)
            for b in crowded:
                m.parts["removed"].pop(str(b), None)

    def compact(self) -> int:
        """A new version in which every bucket is one part."""
        return self.publish(self.read_state(), self.read_chunks(), base=True)

    def _sweep(self, v: int) -> None:
        """Remove what the versions from v - keep on do not need, parts of attempts that came to nothing included."""
        first = v - self.keep
        if first < 1:
            return
        published = f"{self.path}/published"
        numbers = {int(n[:-5]) for n in names_in(self.spark, published) if n.endswith(".json")}
        kept = [self._manifest(n) for n in sorted(numbers) if n >= first]
        for kind in _KINDS:
            needed = {(p, b) for m in kept for b, parts in m.parts[kind].items() for p in parts}
            parts = {p for p, _ in needed}
            for name in names_in(self.spark, f"{self.path}/{kind}"):
                number = re.match(r"part=(([0-9]+)-.*)", name)
                if not number or int(number[2]) > first:
                    continue
                if number[1] not in parts:
                    delete_path(self.spark, f"{self.path}/{kind}/{name}")
                    continue
                for inner in names_in(self.spark, f"{self.path}/{kind}/{name}"):
                    if inner.startswith("bucket=") and (number[1], inner[7:]) not in needed:
                        delete_path(self.spark, f"{self.path}/{kind}/{name}/{inner}")
        for n in numbers:
            if n < first:
                delete_path(self.spark, f"{published}/{n}.json")


def _only(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    named = keys.select(F.col(keys.columns[0]).alias(key))
    return rows.join(named, key, "left_semi")
