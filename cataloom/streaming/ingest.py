"""Incremental ingest: files of candidates arrive, each id is kept once, restarts go on where they stopped."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.resolve import first_arrivals

#: State is kept in this store, changes only a batch; it holds one flag for each key.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_rows(batch: DataFrame, known: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key of the batch that the table does not have yet, columns as in the batch."""
    return first_arrivals(batch, [key], [order]).join(known.select(key), key, "left_anti").select(*batch.columns)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def stored(spark: SparkSession, table: str, schema: StructType | str) -> DataFrame:
    """The rows of a table that ``ingest`` adds to, in whatever folders of it they lie."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(table)


class FirstOfKey(StatefulProcessor):
    """Lets the first row of each key through, by ``order`` within a micro-batch, and remembers the key."""

    def __init__(self, columns: list[str], order: str):
        self.columns, self.order = columns, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best = None
        for b in rows:  # a hot key's rows come in several frames, of which the first row is held
            own = b.astype(object).where(b.notna(), None).sort_values(self.order, kind="stable", na_position="last").iloc[:1]
            best = own if best is None else pd.concat([best, own]).sort_values(self.order, kind="stable", na_position="last").iloc[:1]
        if best is None or self.seen.exists():
            return
        self.seen.update((True,))
        yield best[self.columns]

    def close(self) -> None:
        pass


def _firsts(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in each Arrow batch, so that few rows of a hot key are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = pc.sort_indices(b, sort_keys=[(order, "ascending")], null_placement="at_end").to_numpy()
                codes = pc.dictionary_encode(b.column(key), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                b = b.take(pa.array(at[np.sort(np.unique(codes[at], return_index=True)[1])]))
            yield b

    return stream.mapInArrow(run, stream.schema)


def _files_of_batches(table: str) -> Callable[[DataFrame, int], None]:
    """Each micro-batch in a folder of its own under ``table``, which a repeated batch writes anew."""

    def put(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{table}/batch-{run}-{batch_id:09d}")

    return put


def _until_read(writer: DataStreamWriter, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest(
    spark: SparkSession, source: str, schema: str, table: str, checkpoint: str, key: str = "id", order: str = "ordinal",
    files_a_batch: int = 100, source_format: str = "json",
) -> None:
    """Read what has arrived since the last call, add rows with new keys to ``table`` (Parquet).

    Which keys are known is keyed state: a micro-batch looks up its own keys and reads nothing of the
    table.  Only a checkpoint that is new reads the keys of a table that is there, as the state to start
    from.  The checkpoint folder holds which files are done; a batch that was cut short is read again and
    written again to the same place.  Of a hot key one row an Arrow batch is shuffled.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).format(source_format).load(source)
    fields: StructType = stream.schema
    start = None
    if not _exists(spark, f"{checkpoint}/offsets") and _exists(spark, table):
        start = stored(spark, table, fields).select(key).distinct().groupBy(key)
    fresh = _firsts(stream, key, order).groupBy(key).transformWithStateInPandas(FirstOfKey(fields.names, order), fields, "append", "none", start)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        _until_read(fresh.writeStream.foreachBatch(_files_of_batches(table)), checkpoint)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def running_counts(spark: SparkSession, source: str, schema: str, by: str, checkpoint: str, table: str, files_a_batch: int = 1) -> DataFrame:
    """Counts by a column over all files, as a stream over micro-batches that ends when all are read.

    Each micro-batch writes the counts that it changed to a folder of ``table``; the latest of each value
    hold, so the driver holds none.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{table}/batch-{batch_id:09d}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    counted = stream.groupBy(by).agg(F.count("*").alias("n"))
    _until_read(counted.writeStream.outputMode("update").foreachBatch(put), checkpoint)
    changes = stored(spark, table, StructType([*counted.schema, StructField("batch", IntegerType())]))
    return changes.groupBy(by).agg(F.max_by("n", "batch").alias("n"))
