"""What a stream carries from micro-batch to micro-batch per key, in hash buckets that a batch touches one by one."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtide.plans.lineage import create_file, delete_path, names_in, path_exists, read_file


class KeyedCarry:
    """One row per key, at `path`. A batch reads the buckets of its keys and writes them anew; the others stay where the
    batch that touched them last has put them.

    Each batch leaves a list of the buckets and the batch that holds each: it follows from the list before and the
    batch's rows, so a batch that runs again writes the same. `buckets` counts for a new carry only.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int | None = None) -> None:
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _list(self, batch: int) -> dict:
        if batch < 0:
            return {"buckets": self._buckets, "held": {}}
        return json.loads(read_file(self.spark, f"{self.path}/{batch}.json"))

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, batch: int) -> list[int]:
        """Buckets that batch number `batch` touches: at most as many numbers as there are buckets."""
        bucket = self._bucket(self._list(batch - 1)["buckets"])
        return sorted(r.b for r in rows.select(bucket.alias("b")).distinct().collect())

    def read(self, batch: int, touched: Sequence[int] | None = None) -> DataFrame:
        """What batch number `batch` finds, in the touched buckets or in all."""
        held = self._list(batch - 1)["held"]
        wanted = held if touched is None else [str(b) for b in touched if str(b) in held]
        paths = [f"{self.path}/part={held[b]}/bucket={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, batch: int, rows: DataFrame, touched: Sequence[int]) -> None:
        """`rows` are all there is in the touched buckets after this batch."""
        known = self._list(batch - 1)
        place = f"{self.path}/part={batch}"
        dealt = rows.withColumn("bucket", self._bucket(known["buckets"])).hint("rebalance", F.col("bucket"))
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(place)
        held = {b: p for b, p in known["held"].items() if int(b) not in set(touched)}
        held |= {n.split("=")[1]: batch for n in names_in(self.spark, place) if n.startswith("bucket=")}
        note = f"{self.path}/{batch}.json"
        delete_path(self.spark, note)
        create_file(self.spark, note, json.dumps({**known, "held": held}))
        self._sweep(batch - 1, known["held"])

    def _sweep(self, last: int, held: dict) -> None:
        """Remove what batch `last` replaced: only the lists of it and of the batch after it can still be asked for."""
        parts = set(held.values())
        if last not in parts:
            # it has closed what it touched
            delete_path(self.spark, f"{self.path}/part={last}")
        before = f"{self.path}/{last - 1}.json"
        if last < 1 or not path_exists(self.spark, before):
            return
        for b, p in self._list(last - 1)["held"].items():
            if held.get(b) != p:
                delete_path(self.spark, f"{self.path}/part={p}/bucket={b}" if p in parts else f"{self.path}/part={p}")
        delete_path(self.spark, before)
