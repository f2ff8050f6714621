"""Dense numbers: 0 … n-1 once each, along an order when one is given."""

from pyspark.sql import functions as F

from linkgraph.operators.numbering import numbered


def test_numbers_are_dense_and_follow_the_order(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x")).repartition(7)
    out, _ = numbered(rows, "n", F.col("x").desc())
    assert sorted(tuple(r) for r in out.collect()) == [(x, 999 - x) for x in range(1000)]


def test_numbers_without_an_order_need_no_shuffle(spark):
    rows = spark.range(500, numPartitions=5).where("id % 3 = 0")
    out, _ = numbered(rows, "n")
    assert sorted(r["n"] for r in out.collect()) == list(range(167))
    assert "Exchange hash" not in out._jdf.queryExecution().toString() and "rangepartitioning" not in out._jdf.queryExecution().toString()


def test_empty_partitions_ties_and_empty_input(spark):
    rows = spark.createDataFrame([(1,)] * 6 + [(2,)] * 3, "x int").repartition(20)
    out, _ = numbered(rows, "n", F.col("x"))
    got = sorted(tuple(r) for r in out.collect())
    assert [n for _, n in got] == list(range(9)) and [x for x, _ in got] == [1] * 6 + [2] * 3
    assert numbered(rows.limit(0), "n", F.col("x"))[0].collect() == []
