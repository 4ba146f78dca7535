"""Running values along an order, for keys of any size.

A window over one key is one task.  Here rows are dealt by ranges of (key, order), so a hot key spans many
tasks; each task works out its running value from nothing, and what the tasks before it bring to the
key that a range begins with, one row a range at most, is joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from .scratch import Scratch


def in_ranges(rows: DataFrame, keys: list[str | Column], run: Callable[[int, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``run(number of the range, its batches)`` over ``rows`` dealt by ranges of ``keys`` and sorted by them."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from run(TaskContext.get().partitionId(), batches)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(numbered, schema)


def edges(ranged: DataFrame, part: str, key: str, order: str, values: list[str]) -> list[dict]:
    """For each range its first key, its last key and the ``values`` at its last row: a row a range."""
    last = F.max_by(F.struct(F.col(key).alias("last"), *values), F.struct(key, order))
    rows = ranged.groupBy(F.col(part).alias("part")).agg(F.min(key).alias("first"), last.alias("end"))
    return [{"part": r["part"], "first": r["first"], **r["end"].asDict()} for r in rows.orderBy("part").collect()]


def brought(ends: list[dict], values: list[str], add: bool = True) -> list[tuple]:
    """(part, key, values): what the ranges before bring to the first key of each range.

    ``add``: the values of a key's ranges are summed; else the latest range's values hold, or those
    before where its first value is null.
    """
    out, key, held = [], None, [0] * len(values)
    for e in ends:
        if key is not None and e["first"] == key:
            out.append((e["part"], key, *held))
        if e["last"] == key and add:
            held = [h + e[v] for h, v in zip(held, values)]
        elif e["last"] == key and e[values[0]] is None:
            continue
        else:
            key, held = e["last"], [e[v] for v in values]
    return out


def with_brought(ranged: DataFrame, part: str, key: str, key_type: str, carries: list[tuple], values: dict[str, str]) -> DataFrame:
    """``ranged`` with a column for each of ``values`` (name: type), null where nothing is brought.

    At most one row for each range is broadcast.
    """
    schema = f"`{part}` int, `{key}` {key_type}, " + ", ".join(f"`{n}` {t}" for n, t in values.items())
    return ranged.join(F.broadcast(ranged.sparkSession.createDataFrame(carries, schema)), [part, key], "left")


def with_latest(rows: DataFrame, key: str, order: str, values: list[str], scratch: Scratch, name: str = "latest", flag: str | None = None) -> DataFrame:
    """``rows`` with ``before_<order>`` and ``before_<value>``: those of the latest row before each on its key,
    or the latest for which ``flag`` holds; null where there is none.

    ``key`` and ``order`` are not null, and (key, order) is unique.  The same as a window over the key, for
    keys that hold any share of the rows.
    """
    kept, taken = list(rows.columns), [order, *values]
    fields = [StructField(f"before_{v}", rows.schema[v].dataType) for v in taken]
    schema = StructType([StructField("_part", IntegerType()), *(StructField(f.name, f.dataType) for f in rows.schema), *fields])

    def run(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for b in batches:
            n, keys = b.num_rows, b.column(key)
            if not n:
                continue
            first = np.r_[True, pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)]
            start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
            good = np.ones(n, dtype=bool) if flag is None else pc.fill_null(b.column(flag), False).to_numpy(zero_copy_only=False)
            latest = np.maximum.accumulate(np.where(good, np.arange(n), -1))
            before = np.r_[-1, latest[:-1]]
            inside = before >= start
            goes_on = (start == 0) & (held is not None) & (keys[0] == last)
            pool = [pa.concat_arrays([held.column(v) if held is not None else pa.nulls(1, b.column(v).type), b.column(v)]) for v in taken]
            at = pa.array(np.where(inside, before + 1, 0), mask=~inside & ~goes_on)
            made = [p.take(at) for p in pool]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part), pa.int32()), *(b.column(c) for c in kept), *made], schema.names)
            begin = int(start[-1])
            if latest[-1] >= begin:
                held = b.slice(int(latest[-1]), 1)
            elif not (begin == 0 and held is not None and keys[0] == last):
                held = None
            last = keys[n - 1]

    ranged = scratch.save(in_ranges(rows, [key, order], run, schema), name)
    good = F.lit(True) if flag is None else F.coalesce(F.col(flag), F.lit(False))
    now = ranged.select("_part", key, order, *(F.when(good, F.col(v)).otherwise(F.col(f"before_{v}")).alias(f"_{v}") for v in taken))
    carries = [c for c in brought(edges(now, "_part", key, order, [f"_{v}" for v in taken]), [f"_{v}" for v in taken], add=False) if c[2] is not None]
    carried = StructType([StructField("_part", IntegerType()), StructField(key, rows.schema[key].dataType), *(StructField(f"_{v}", rows.schema[v].dataType) for v in taken), StructField("_brought", BooleanType())])
    found = rows.sparkSession.createDataFrame([(*c, True) for c in carries], carried)
    joined = ranged.join(F.broadcast(found), ["_part", key], "left")  # a row a range at most
    use = F.col(f"before_{order}").isNull() & F.col("_brought")
    return joined.select(*kept, *(F.when(use, F.col(f"_{v}")).otherwise(F.col(f"before_{v}")).alias(f"before_{v}") for v in taken))
