"""Sources and sinks: compressed dump scan, graph snapshot round trip, text output."""

import tempfile

from wiki14 import WIKI14
from pyspark.sql import functions as F

from linkgraph.operators.graph import edge_pairs
from linkgraph.operators.rank import rank_nodes, run_rank, prepare_graph
from linkgraph.operators.topk import top_k
from linkgraph.plans.jobs import ingest_lines
from linkgraph.sources import read_graph, read_lines, write_graph, write_ranked_text


def test_bz2_dump_reads_like_plain_lines(spark, wiki14):
    d = tempfile.mkdtemp(prefix="lg-bz2-")
    spark.createDataFrame([(x,) for x in WIKI14], "value string").coalesce(1) \
        .write.text(f"{d}/dump", compression="bzip2")
    ing = ingest_lines(read_lines(spark, f"{d}/dump"))
    assert dict(ing.report().collect()) == dict(wiki14.report().collect())
    assert ing.graph.edges.count() == 13


def test_graph_snapshot_round_trip(spark, wiki14):
    d = tempfile.mkdtemp(prefix="lg-graph-")
    write_graph(wiki14.graph, f"{d}/g")
    back = read_graph(spark, f"{d}/g")
    a = sorted(map(tuple, edge_pairs(wiki14.graph).collect()))
    b = sorted(map(tuple, edge_pairs(back).collect()))
    assert a == b
    ra = {r.id: r.rank for r in rank_nodes(wiki14.graph).collect()}
    rb = {r.id: r.rank for r in rank_nodes(back).collect()}
    assert ra.keys() == rb.keys()
    assert all(abs(ra[k] - rb[k]) < 1e-15 for k in ra)


def test_ranked_text_and_round_snapshots(spark, wiki14):
    d = tempfile.mkdtemp(prefix="lg-out-")
    write_ranked_text(top_k(rank_nodes(wiki14.graph), 3), f"{d}/top", decimals=6)
    lines = [r.value for r in spark.read.text(f"{d}/top").collect()]
    assert lines == ["C 0.325656", "A 0.186716", "B 0.101248"]
    prep = prepare_graph(wiki14.graph)
    run_rank(prep, iterations=2, snapshots=f"{d}/rounds")
    snap = spark.read.parquet(f"{d}/rounds")
    assert sorted(r.iter for r in snap.select("iter").distinct().collect()) == [1, 2]
    assert snap.where(F.col("iter") == 2).count() == 11
    prep.release()


def test_command_line_writes_all_outputs(spark, capsys):
    from linkgraph.__main__ import main

    d = tempfile.mkdtemp(prefix="lg-cli-")
    spark.createDataFrame([(x,) for x in WIKI14], "value string").coalesce(1) \
        .write.text(f"{d}/dump", compression="bzip2")
    assert main([f"{d}/dump", f"{d}/graph", f"{d}/ranks", f"{d}/top", "--k", "2"]) == 0
    printed = capsys.readouterr().out
    assert "ok: 9" in printed and "10 rounds took" in printed
    top = [r.value for r in spark.read.text(f"{d}/top").collect()]
    assert [t.split(" ")[0] for t in top] == ["C", "A"]
    assert abs(float(top[0].split(" ")[1]) - 0.325656302036) < 1e-11
    assert spark.read.parquet(f"{d}/ranks").select("iter").distinct().count() == 10
    assert read_graph(spark, f"{d}/graph").edges.count() == 12   # 13 links, one repeat merged


def test_snapshot_spreads_a_hot_source(spark):
    from linkgraph.operators.graph import Graph

    d = tempfile.mkdtemp(prefix="lg-hot-")
    pairs = [("hub", f"t{i:05d}") for i in range(6000)] + [(f"s{i}", f"t{i:05d}") for i in range(3000)]
    g = Graph(edges=spark.createDataFrame(pairs, "src string, dst string").repartition(8))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")           # at this size AQE would merge it all into one file
    try:
        write_graph(g, f"{d}/g")
    finally:
        spark.conf.unset(key)
    per_file = [r.n for r in read_graph(spark, f"{d}/g").edges.groupBy(F.input_file_name())
                .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per_file) == 9000
    assert len(per_file) > 1 and max(per_file) < 6000      # the hub's links span several files


def test_run_dump_top_k(spark):
    from linkgraph import run_dump

    d = tempfile.mkdtemp(prefix="lg-dump-")
    spark.createDataFrame([(x,) for x in WIKI14], "value string").write.text(f"{d}/dump")
    top = run_dump(spark, f"{d}/dump", k=3).collect()
    assert [r.name for r in top] == ["C", "A", "B"]
    assert abs(top[0].rank - 0.325656302036) < 1e-11


def test_page_table_source(spark):
    from linkgraph.plans.graphs import page_nav
    from linkgraph.plans.jobs import ingest_pages
    from linkgraph.sources import read_page_table

    d = tempfile.mkdtemp(prefix="lg-pages-")
    src = page_nav(spark, "/root/testdata/sf0.001").withColumnRenamed("page", "name").withColumnRenamed("html", "body")
    src.write.parquet(f"{d}/pages")
    table = read_page_table(spark, f"{d}/pages", page_col="name", html_col="body")
    assert table.columns == ["page", "html"]
    a = sorted(map(tuple, ingest_pages(table).links.collect()))
    b = sorted(map(tuple, ingest_pages(page_nav(spark, "/root/testdata/sf0.001")).links.collect()))
    assert a == b and len(a) == 281


def test_ranked_text_of_a_whole_table_is_globally_ordered(spark):
    import glob

    from linkgraph.plans.graphs import trade_graph

    d = tempfile.mkdtemp(prefix="lg-order-")
    ranks = rank_nodes(trade_graph(spark, "/root/testdata/sf0.001"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")            # keep several part files at this size
    try:
        write_ranked_text(ranks, f"{d}/all", decimals=12)
    finally:
        spark.conf.unset(key)
    parts = sorted(glob.glob(f"{d}/all/part-*"))
    assert len(parts) > 1
    lines = [line.rstrip("\n") for p in parts for line in open(p)]
    assert len(lines) == ranks.count()
    values = [float(x.split(" ")[1]) for x in lines]
    assert values == sorted(values, reverse=True)
