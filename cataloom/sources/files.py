"""Readers of stored records."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.lexicon import TAXONOMY


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; blank lines are skipped, a missing path gives an empty table, broken lines are kept
    in _corrupt_record where the schema has that column."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType | str, expected: int | None = None) -> DataFrame:
    """A JSON array; with ``expected`` the job fails unless it has that many rows."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    if expected is None:
        return rows
    counted = rows.agg(F.count("*").alias("_n"))
    sure = F.assert_true(F.col("_n") == expected, F.concat(F.lit(f"Expected exactly {expected} records, got "), F.col("_n").cast("string")))
    checked = counted.select(F.coalesce(sure.cast("string"), F.lit("fine")).alias("_fine"))
    return rows.crossJoin(F.broadcast(checked)).where("_fine = 'fine'").drop("_fine")  # one row, whatever the input


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns strings."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def split_by_flag(rows: DataFrame, flag: str = "is_baseline") -> tuple[DataFrame, DataFrame]:
    """Rows with the flag true and with it false; rows where it is null fall in neither."""
    return rows.where(F.col(flag)), rows.where(~F.col(flag))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str, limit: int, **constants: str) -> DataFrame:
    """The first ``limit`` rows of a list, with constant provenance columns."""
    return spark.createDataFrame(rows[:limit], schema).withColumns({k: F.lit(v) for k, v in constants.items()})


def taxonomy(path: str | None = None) -> tuple[str, ...]:
    """The categories of a YAML settings file, or the fixed ones where file or key is missing."""
    if path and Path(path).exists():
        try:
            import yaml

            found = ((yaml.safe_load(Path(path).read_text("utf-8")) or {}).get("taxonomy") or {}).get("categories")
            if isinstance(found, list) and found:
                return tuple(found)
        except (ImportError, ValueError, AttributeError):
            return TAXONOMY
    return TAXONOMY
