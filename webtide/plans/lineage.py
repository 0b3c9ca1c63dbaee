"""Tables written between the rounds of an iterative job, in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for a local session without it."""
    base = spark.conf.get(_CONF, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="webtide-")
    spark.conf.set(_CONF, base)
    return base


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    files, place = _place(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def read_file(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it; nothing happens if there is none."""
    files, place = _place(spark, path)
    files.delete(place, True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this text; False if there is one already, which then stays as it is."""
    files, place = _place(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


class Scratch:
    """Written tables of one job. They outlive executors, and cut the plan where they are read again."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._id = uuid.uuid4().hex
        self.base = f"{shared_dir(spark)}/webtide-{self._id}"

    def save(self, df: DataFrame, name: str, *counts) -> tuple[DataFrame, dict]:
        """Write once, count on the way (aggregate Columns in `counts`), read back."""
        observed = Observation()
        aggs = counts or (F.count(F.lit(1)).alias("rows"),)
        df.observe(observed, *aggs).write.mode("overwrite").parquet(f"{self.base}/{name}")
        return self.read(df, name), observed.get

    def read(self, like: DataFrame, *names: str) -> DataFrame:
        """Several saved tables of one shape as a single scan."""
        paths = [f"{self.base}/{n}" for n in names]
        return self.spark.read.schema(like.schema).parquet(*paths)

    def add_bucketed(self, df: DataFrame, name: str, key: str, buckets: int, *counts) -> tuple[DataFrame, dict]:
        """Write rows dealt out and sorted by `key`, to those that `name` has already; read all of them back.

        Tables with as many buckets meet on their keys where they lie: no join on them is a shuffle. To be read as
        long as `forget` has not been called.
        """
        observed = Observation()
        aggs = counts or (F.count(F.lit(1)).alias("rows"),)
        writer = df.observe(observed, *aggs).write.mode("append").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{self.base}/{name}").saveAsTable(self._table(name))
        return self.spark.table(self._table(name)), observed.get

    def _table(self, name: str) -> str:
        return f"webtide_{self._id}_{name}"

    def forget(self, *names: str) -> None:
        """Take bucketed tables out of the catalog; their files stay, to be read with `read`."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
