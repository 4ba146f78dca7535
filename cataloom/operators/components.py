"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


SALTS = 16


def _with_low(directed: DataFrame, low: DataFrame) -> DataFrame:
    """``directed`` (u, v) with the ``low`` of u.  The links of a hub are dealt by a hash of v to
    ``SALTS`` groups, and each node's low goes to all of them."""
    dealt = directed.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    every = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(every, ["u", "salt"]).drop("salt")


def _minimum_by_node(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minimum_by_node(both).withColumn("low", F.least("low", "u"))
    return _with_low(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minimum_by_node(down)
    linked = _with_low(down, low).where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return linked.unionAll(low.select("u", F.col("low").alias("v")))


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """(u, v) links between long ids -> (node, root), root the smallest id reachable.

    Only nodes that occur in a link to another node are returned.  Each round is two shuffles on the
    node and is written to the shared folder; the links never leave the executors.  Rounds end
    when the star forest stops changing (its size and an order-free hash are compared), after
    about log2 of the longest chain.
    """
    current = scratch.save(edges.where("u <> v").select("u", "v").distinct(), f"{name}_0")
    mark, step = None, 0
    while True:
        facts = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if facts["n"] == 0 or (facts["n"], facts["h"]) == mark:
            break
        if step >= max_rounds:
            raise RuntimeError(f"links did not settle in {max_rounds} rounds")
        mark, step = (facts["n"], facts["h"]), step + 1
        following = _small_star(_large_star(current)).distinct()
        current = scratch.save(following, f"{name}_{step}")
        scratch.drop(f"{name}_{step - 1}")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
