import pytest
from pyspark.sql import functions as F

from cataloom.sources import items, search


def item(i, stars, topics=("mcp",)):
    return (i, f"n{i}", f"https://github.com/o/n{i}", None, ("o", None), list(topics) if topics is not None else None, "", stars, None, None, None, None)


PAGES = [
    ("a", 1, 200, [item(1, 900), item(2, 400, ("rag", "mcp-server"))]), ("a", 2, 200, [item(3, 300), item(4, None, None)]), ("a", 3, 200, [item(5, 950, ())]),
    ("b", 1, 200, [item(6, 50), item(7, 40, ("rag",))]), ("b", 2, 500, None), ("c", 1, 200, []),
]


@pytest.fixture
def recorded(spark, tmp_path):
    path = str(tmp_path / "p")
    items.record_items(spark.createDataFrame(PAGES, search.PAGE), path)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query, ids, pages", [
    ("stars:>500", [1, 5], 2), ("stars:100..400", [2, 3], 2), ("stars:40", [7], 1), ("topic:mcp stars:>=300", [1, 3], 3), ("topic:rag", [2, 7], 6), ("stars:<10", [], 1), ("stars:<=50 topic:mcp", [6], 1),
])
def test_filters_close_pages(spark, recorded, query, ids, pages):
    found = items.items(spark, recorded).where(items.slice_filter(query))
    assert sorted(r["id"] for r in found.collect()) == ids
    assert found.rdd.getNumPartitions() == pages and " Filter " not in plan(found)


def test_filters_on_queries_and_what_is_left_to_spark(spark, recorded):
    found = items.items(spark, recorded).where("query in ('b', 'c') and name is not null and length(name) = 2")
    assert sorted(r["id"] for r in found.collect()) == [6, 7] and found.rdd.getNumPartitions() == 3
    assert "length(name" in plan(found)


def test_one_order_in_a_slice(spark, recorded):
    found = {(r["query"], r["place"]): r["id"] for r in items.items(spark, recorded, in_order=True).collect()}
    assert [found["a", k] for k in range(5)] == [5, 1, 2, 3, 4] and [found["b", k] for k in range(2)] == [6, 7]
    some = items.items(spark, recorded, in_order=True).where("query = 'a' and stargazers_count < 500")
    assert sorted((r["place"], r["id"]) for r in some.collect()) == [(2, 2), (3, 3)] and some.rdd.getNumPartitions() == 1


def test_a_killed_stream_goes_on(spark, recorded, tmp_path):
    """Page 2 of b is refused and page 3 missing; a batch that fails is read again, pages done are not."""
    out, checkpoint, told = str(tmp_path / "out"), str(tmp_path / "cp"), []

    def run(fail=False):
        def put(batch, n):
            told.append(sorted((r["query"], r["page"]) for r in batch.select("query", "page").distinct().collect()))
            if fail:
                raise ValueError("killed")
            batch.write.mode("overwrite").parquet(f"{out}/n{n}")

        query = items.stream_items(spark, recorded).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        if fail:
            with pytest.raises(Exception, match="killed"):
                query.awaitTermination()
        else:
            query.awaitTermination()

    run()
    assert told == [[("a", 1), ("a", 2), ("a", 3), ("b", 1)]]
    more = [("a", 4, 200, [item(8, 1)]), ("b", 4, 200, [item(9, 1)])]
    spark.createDataFrame(more, search.PAGE).write.mode("append").partitionBy("query", "page").json(f"{recorded}/pages")
    run(fail=True)
    run()
    assert told[1:] == [[("a", 4)], [("a", 4)]]
    spark.createDataFrame([("b", 3, 200, [item(10, 1)])], search.PAGE).write.mode("append").partitionBy("query", "page").json(f"{recorded}/pages")
    run()
    assert told[-1] == [("b", 3), ("b", 4)]
    stored = spark.read.schema(items.ITEMS).option("recursiveFileLookup", True).parquet(out)
    assert sorted(r["id"] for r in stored.collect()) == list(range(1, 11))
