"""Top-k ordering, ties, exclusion and text output."""

from linkgraph.functions import format_rank
from linkgraph.operators.topk import format_ranked, top_k


def test_top_k_order_ties_and_short_input(spark):
    df = spark.createDataFrame([("b", 0.2), ("a", 0.2), ("c", 0.5), ("d", 0.1)], "id string, rank double")
    assert [r.name for r in top_k(df, 3).collect()] == ["c", "a", "b"]
    assert top_k(df, 100).count() == 4
    assert [r.name for r in top_k(df, 2, exclude=["c"]).collect()] == ["a", "b"]


def test_all_tied(spark):
    df = spark.createDataFrame([(f"n{i:03d}", 0.01) for i in range(150)], "id string, rank double")
    names = [r.name for r in top_k(df, 100).collect()]
    assert names == [f"n{i:03d}" for i in range(100)]


def test_text_forms(spark):
    df = spark.createDataFrame([("x", 0.000123), ("y", 0.5)], "name string, rank double")
    java = [r.value for r in format_ranked(df).collect()]
    assert java == ["y 0.5", "x 1.23E-4"]
    fixed = [r.value for r in format_ranked(df, decimals=4).collect()]
    assert fixed == ["y 0.5000", "x 0.0001"]
    assert df.select(format_rank("rank", 2).alias("t")).first().t == "0.00"
