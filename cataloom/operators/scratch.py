"""Intermediate tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; where it is unset, a folder of our own in local mode (tests, one
    machine), and an error on a cluster, whose executors would not see it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if "dir" not in _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="cataloom-")
        atexit.register(shutil.rmtree, _OWN["dir"], True)
    return "file://" + _OWN["dir"]


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is none of ``taken``, whatever the case."""
    held = {c.lower() for c in taken}
    while name in held:
        name += "_"
    return name


def columns(df: DataFrame) -> list[str]:
    """The column names of ``df``, quoted."""
    return ["`" + c.replace("`", "``") + "`" for c in df.columns]


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Named Parquet tables of one operator call.

    ``save`` writes a DataFrame and rereads it, so later jobs survive lost executors without
    recomputing it; ``drop`` frees a table that nothing lazy refers to any more.  What is still
    there when the driver ends is deleted then.
    """

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{operator}-{uuid.uuid4().hex}"
        atexit.register(self._clean)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, f"{self.root}/{name}")

    def _clean(self) -> None:
        try:
            _delete(self.spark, self.root)
        except Exception:  # the JVM may be gone already
            pass
