"""Plan checks: the shapes the design relies on, read from the physical plan tree.

Nodes are counted by walking plan children (the plan text also prints the
plans inside cached relations, which would over-count).
"""

import pytest
from pyspark.sql import functions as F

from linkgraph.operators import rank as R
from linkgraph.operators.topk import top_k
from linkgraph.plans.graphs import trade_graph, wiki_lines
from linkgraph.plans.jobs import ingest_lines

SF = "/root/testdata/sf0.001"


def plan_nodes(df):
    root = df._jdf.queryExecution().executedPlan()
    out = []

    def walk(p):
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(p.executedPlan())
            return
        out.append((name, p))
        kids = p.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(root)
    return out


def names(df):
    return [n for n, _ in plan_nodes(df)]


def test_top_k_is_take_ordered(spark):
    r = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.rand(1).alias("rank"))
    assert "TakeOrderedAndProject" in names(top_k(r, 100))


@pytest.mark.parametrize("cache", [True, False])
def test_round_plan_moves_no_edges_and_broadcasts_nothing(spark, cache):
    prep = R.prepare_graph(trade_graph(spark, SF), cache_edges=cache)
    r0 = R.initial_ranks(prep, float(prep.n_nodes)).checkpoint()
    r1 = R.rank_step(prep, r0, float(prep.n_nodes), delta=0.0)
    nodes = plan_nodes(r1)
    kinds = [n for n, _ in nodes]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange",
                "BroadcastHashJoin", "SortMergeJoin"):
        assert bad not in kinds, bad
    assert kinds.count("ShuffledHashJoin") == 1
    # two exchanges per round: ranks to the edge layout, contributions by vertex
    assert kinds.count("Exchange") == 2
    # the edge side of the join is the bucketed scan itself, with no exchange above it
    join = next(p for n, p in nodes if n == "ShuffledHashJoin")
    edge_side = [n for n, _ in plan_nodes_of(join.left())]
    assert "Exchange" not in edge_side
    # the edge side reads the bucketed table, directly or through its cache
    scans = [p.simpleString(1000) for n, p in plan_nodes_of(join.left())
             if n.startswith("Scan") or n == "InMemoryTableScan"]
    assert scans
    if not cache:
        assert all("Bucketed: true" in s for s in scans)
    # the plan of a later round is the same size: no lineage growth
    r1c = r1.checkpoint()
    r2 = R.rank_step(prep, r1c, float(prep.n_nodes), delta=0.0)
    assert sorted(names(r2)) == sorted(kinds)
    prep.release()


def plan_nodes_of(p):
    out = []

    def walk(q):
        out.append((q.nodeName(), q))
        kids = q.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(p)
    return out


def test_ingest_runs_next_to_the_scan(spark):
    ing = ingest_lines(wiki_lines(spark, SF), materialize=False)
    kinds = names(ing.extracted)
    assert any("MapInArrow" in k for k in kinds)
    assert "Exchange" not in kinds          # parsing needs no shuffle


def test_scans_read_only_needed_columns(spark):
    edges = trade_graph(spark, SF).edges
    scans = [p.simpleString(1000) for n, p in plan_nodes(edges) if "Scan" in n]
    li = [s for s in scans if "lineitem" in s]
    assert li and all("l_quantity" not in s and "l_shipdate" not in s for s in li)
    orders = [s for s in scans if "orders" in s]
    assert orders and all("o_totalprice" not in s for s in orders)
    wiki = [p.simpleString(1000) for n, p in plan_nodes(wiki_lines(spark, SF)) if "Scan" in n]
    assert wiki and all("url" not in s.split("ReadSchema")[1] for s in wiki)


def _hash_exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_vertex_queries_shuffle_once(spark):
    from linkgraph.operators.graph import Graph, dangling_nodes, node_universe

    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    for graph in (Graph(edges), Graph(edges, pages=edges.select("src").withColumnRenamed("src", "id"))):
        assert _hash_exchanges(node_universe(graph)) == _hash_exchanges(dangling_nodes(graph)) == 1


def test_report_reads_the_reason_only(wiki14):
    plan = wiki14.report()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<reason:string>" in plan


def test_merged_links_are_not_merged_again(spark, tmp_path):
    from linkgraph.operators.graph import Graph, edge_pairs
    from linkgraph.sources import read_graph, write_graph

    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "c")], "src string, dst string")
    write_graph(Graph(edges), str(tmp_path / "g"))
    pairs = edge_pairs(read_graph(spark, str(tmp_path / "g")))
    assert _hash_exchanges(pairs) == 0
    assert sorted(map(tuple, pairs.collect())) == [("a", "b", 2), ("b", "c", 1)]


def test_hot_target_is_spread_without_adaptive_execution(spark):
    from pyspark.sql import functions as F
    from linkgraph.operators import rank as R

    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        n = 40_000
        links = spark.range(n).select(F.concat(F.lit("s"), "id").alias("src"),
                                      F.when(F.col("id") % 10 < 6, F.lit("hub")).otherwise(F.concat(F.lit("t"), "id")).alias("dst"))
        ids = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct().withColumn("vid", F.xxhash64("id"))
        hot = ids.where("id = 'hub'")
        out = R._with_vids(links, "dst", "src", ids, hot, [F.col("vid").alias("dst_vid")])
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("dst_vid").alias("n")).collect()]
        assert len(sizes) == 16
        assert sum(sizes) == n and max(sizes) <= 3 * n / 16
        assert out.where(F.col("dst_vid") != F.xxhash64("dst")).count() == out.where("dst_vid is null").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_release_removes_what_the_preparation_wrote(spark):
    import os
    from linkgraph.operators.graph import Graph
    from linkgraph.operators.rank import prepare_graph

    prep = prepare_graph(Graph(spark.createDataFrame([("a", "b")], "src string, dst string")))
    local = [p.removeprefix("file:") for p in prep.paths]
    assert len(local) == 3 and all(map(os.path.isdir, local))
    prep.release()
    assert not any(map(os.path.exists, local))


def test_contributions_move_edges_once_and_are_written_as_a_table(spark):
    from linkgraph.plans.queries import QUERIES

    prep = R.prepare_graph(trade_graph(spark, SF), cache_edges=False)
    plan = plan_nodes(R.contributions(prep, R.initial_ranks(prep, float(prep.n_nodes))))
    over_edges = [n for n, p in plan if n.endswith("Join") and prep.table in p.toString()]
    # the edge join, which brings the sources' names along, and that of the targets' names
    assert len(over_edges) == 2
    prep.release()
    assert QUERIES["edge_contributions"](spark, SF).inputFiles()      # parquet, not a checkpoint's rows
