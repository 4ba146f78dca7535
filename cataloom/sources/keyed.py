"""A table of one row a key that takes upserts: copy-on-write by hash buckets.

The rows of a bucket lie in one folder.  An upsert rewrites only buckets that get a row, into new
folders, then swaps a pointer file that says which folder holds each bucket; readers see the table before
or after, never between, and an upsert that fails leaves it as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import replace_file

POINTER = "current.json"


class KeyedTable:
    """``buckets`` is fixed when a table is made; a bucket should hold what a task can rewrite."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType | str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = spark.createDataFrame([], schema).schema
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._system = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _places(self) -> dict[int, str]:
        """The folder of each bucket that has rows: one entry a bucket."""
        pointer = self._hadoop.Path(f"{self.path}/{POINTER}")
        if not self._system.exists(pointer):
            return {}
        held = json.loads(self.spark.read.text(pointer.toString(), wholetext=True).first()[0])
        if held["buckets"] != self.buckets:
            raise ValueError(f"the table has {held['buckets']} buckets")
        return {int(b): folder for b, folder in held["places"].items()}

    def _swap(self, places: dict[int, str]) -> None:
        new, pointer = self._hadoop.Path(f"{self.path}/{POINTER}-{uuid.uuid4().hex}"), self._hadoop.Path(f"{self.path}/{POINTER}")
        out = self._system.create(new, True)
        try:
            out.write(bytearray(json.dumps({"buckets": self.buckets, "places": places}).encode()))
        finally:
            out.close()
        replace_file(self.spark, new, pointer)

    def _read(self, places: dict[int, str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{folder}/bucket={b}" for b, folder in places.items()))

    def rows(self) -> DataFrame:
        return self._read(self._places())

    def upsert(self, rows: DataFrame, order: str | None = None) -> list[int]:
        """Puts ``rows`` in, each in place of the row of its key, and returns the buckets that were rewritten.

        Of rows with one key the last by ``order`` holds, without it the greatest of all columns; a null
        key is a key.  One writer at a time.
        """
        last = Window.partitionBy(self.key).orderBy(*([F.desc(order)] if order else []), *(F.desc(c) for c in self.schema.names))
        new = rows.withColumn("_r", F.row_number().over(last)).where("_r = 1").select(*self.schema.names)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        folder = f"rows-{uuid.uuid4().hex}"
        new.withColumn("bucket", bucket).write.partitionBy("bucket").parquet(f"{self.path}/{folder}-new")
        there = self.spark.read.schema(StructType([*self.schema])).parquet(f"{self.path}/{folder}-new")
        touched = sorted(r[0] for r in there.select(bucket.alias("b")).distinct().collect())  # no more than there are buckets
        places = self._places()
        old = self._read({b: places[b] for b in touched if b in places})
        kept = old.join(there.select(F.col(self.key).alias("_key")).distinct(), F.col(self.key).eqNullSafe(F.col("_key")), "left_anti")
        whole = kept.select(*self.schema.names).unionByName(there.select(*self.schema.names)).withColumn("bucket", bucket)
        whole.repartition(max(1, len(touched)), "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        self._system.delete(self._hadoop.Path(f"{self.path}/{folder}-new"), True)
        self._swap(places | {b: folder for b in touched})
        return touched

    def vacuum(self) -> int:
        """Deletes folders of buckets that no reader is pointed to any more; returns how many."""
        held, gone = {f"{folder}/bucket={b}" for b, folder in self._places().items()}, 0
        for folder in self._system.listStatus(self._hadoop.Path(self.path)):
            name = folder.getPath().getName()
            if folder.isDirectory() and name.startswith("rows-"):
                for b in self._system.listStatus(folder.getPath()):
                    if b.isDirectory() and f"{name}/{b.getPath().getName()}" not in held:
                        self._system.delete(b.getPath(), True)
                        gone += 1
        return gone
