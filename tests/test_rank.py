"""Rank: hand-worked values, invariants, degenerate graphs, the skew split."""

import pytest
from pyspark.sql import functions as F

from linkgraph.operators.graph import Graph
from linkgraph.operators.rank import parity_step, rank_nodes, rank_trace
from linkgraph.operators.topk import top_k

ALPHA = 0.15

# FIXTURES.md §2, computed independently.
PARITY = {"C": 0.221296296296, "A": 0.095370370370, "B": 0.079629629630, "D": 0.048148148148,
          "G H": 0.048148148148, "Q%ZZ": 0.048148148148, "R@amp;amp;D": 0.048148148148,
          "E": 0.016666666667, "G": 0.016666666667, "H": 0.016666666667, "I": 0.016666666667}
STANDARD = {"C": 0.325656302036, "A": 0.186716341369, "B": 0.101247983408, "D": 0.090564920549,
            "G H": 0.048363814868, "Q%ZZ": 0.048363814868, "R@amp;amp;D": 0.048363814868,
            "E": 0.037680752008, "G": 0.037680752008, "H": 0.037680752008, "I": 0.037680752008}


def as_dict(df):
    return {r["id"]: r["rank"] for r in df.collect()}


def edges_graph(spark, pairs, pages=None):
    e = spark.createDataFrame(pairs, "src string, dst string")
    p = spark.createDataFrame([(x,) for x in pages], "id string") if pages is not None else None
    return Graph(edges=e, pages=p)


def test_wiki14_parity_step(wiki14):
    got = as_dict(parity_step(wiki14.graph))
    assert got.keys() == PARITY.keys()
    for k, v in PARITY.items():
        assert got[k] == pytest.approx(v, abs=1e-11)


def test_wiki14_standard_10_rounds(wiki14):
    got = as_dict(rank_nodes(wiki14.graph))
    assert got.keys() == STANDARD.keys()
    for k, v in STANDARD.items():
        assert got[k] == pytest.approx(v, abs=1e-11)
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-12)


def test_split_hot_sources_gives_same_ranks(wiki14, spark):
    whole = as_dict(rank_nodes(wiki14.graph))
    split = as_dict(rank_nodes(wiki14.graph, split=1, partitions=3))
    for k in whole:
        assert split[k] == pytest.approx(whole[k], abs=1e-15)


def test_invariants_on_random_graph(spark):
    import random

    rnd = random.Random(7)
    pairs = [(f"v{rnd.randrange(60)}", f"v{rnd.randrange(80)}") for _ in range(500)]
    g = edges_graph(spark, pairs)
    r = as_dict(rank_nodes(g, split=3))
    n = len(r)
    assert sum(r.values()) == pytest.approx(1.0, abs=1e-9)
    assert min(r.values()) >= ALPHA / n - 1e-15
    # doubling every edge leaves ranks unchanged
    r2 = as_dict(rank_nodes(edges_graph(spark, pairs + pairs)))
    for k in r:
        assert r2[k] == pytest.approx(r[k], abs=1e-12)
    # row order and partitioning do not matter
    shuffled = list(pairs)
    rnd.shuffle(shuffled)
    g3 = Graph(edges=spark.createDataFrame(shuffled, "src string, dst string").repartition(5))
    r3 = as_dict(rank_nodes(g3, partitions=7))
    for k in r:
        assert r3[k] == pytest.approx(r[k], abs=1e-12)


def test_trace_sums_to_one_and_no_dangling_means_no_mass(spark):
    cycle = edges_graph(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")])
    t = rank_trace(cycle, iterations=5).orderBy("iteration").collect()
    assert [r.iteration for r in t] == [1, 2, 3, 4, 5]
    for r in t:
        assert r.rank_sum == pytest.approx(1.0, abs=1e-12)
        assert r.dangling_mass == 0.0


def test_tol_stops_early(spark):
    g = edges_graph(spark, [("a", "b"), ("b", "a")])
    t = rank_trace(g, iterations=10, tol=1e-9).collect()
    assert len(t) == 1            # symmetric graph: already at rest after one round
    assert t[0].l1_change == pytest.approx(0.0, abs=1e-15)


def test_empty_graph(spark):
    g = edges_graph(spark, [])
    assert rank_nodes(g).count() == 0
    assert top_k(rank_nodes(g), 100).count() == 0


def test_page_without_links_and_all_dangling(spark):
    g = edges_graph(spark, [], pages=["x", "y", "z", "w"])
    r = as_dict(rank_nodes(g))
    assert r == pytest.approx({k: 0.25 for k in "xyzw"}, abs=1e-15)


def test_self_loop_only(spark):
    r = as_dict(rank_nodes(edges_graph(spark, [("s", "s")])))
    assert r == {"s": pytest.approx(1.0, abs=1e-15)}


def test_sentinel_name_is_an_ordinary_page(spark):
    g = edges_graph(spark, [("DanglingNode", "a"), ("a", "DanglingNode"), ("b", "a")])
    r = as_dict(rank_nodes(g))
    assert set(r) == {"DanglingNode", "a", "b"}
    names = [x.name for x in top_k(rank_nodes(g), 100).collect()]
    assert "DanglingNode" in names


def test_universe_pages(wiki14):
    got = as_dict(rank_nodes(wiki14.graph, universe="pages"))
    assert set(got) == {"A", "B", "C", "D", "E", "G", "H", "I"}


def test_hot_source_spreads_over_buckets(spark):
    """One vertex holds a third of all edges; its edges must not land in one task."""
    from linkgraph.operators.rank import prepare_graph

    hub = [("hub", f"t{i}") for i in range(3000)]
    rest = [(f"s{i % 700}", f"t{(i * 7919) % 5000}") for i in range(6000)]
    g = edges_graph(spark, hub + rest)
    prep = prepare_graph(g, split=100, partitions=8, cache_edges=False)
    # one file per bucket (the table is repartitioned by its bucket keys before writing)
    per_task = [r["n"] for r in prep.wedges.groupBy(F.input_file_name().alias("f"))
                .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(per_task) == 8
    total = sum(per_task)
    assert total == prep.wedges.count()
    assert max(per_task) < 0.25 * total      # the hub alone would be a third
    hub_vid = prep.nodes.where(F.col("id") == "hub").first()
    assert hub_vid.nb == 30
    r_split = as_dict(rank_nodes(g, split=100, partitions=8))
    r_whole = as_dict(rank_nodes(g))
    for k in r_whole:
        assert r_split[k] == pytest.approx(r_whole[k], abs=1e-15)
    prep.release()


def test_null_ends_are_not_links(spark):
    g = edges_graph(spark, [("a", "b"), (None, "b"), ("a", None)])
    assert as_dict(rank_nodes(g)).keys() == {"a", "b"}


def brute_force(pairs, pages, alpha=ALPHA, iterations=10):
    """Dense power iteration in numpy: the formula, written out directly."""
    import numpy as np

    ids = sorted({x for p in pairs for x in p} | set(pages))
    at = {v: i for i, v in enumerate(ids)}
    n = len(ids)
    m = np.zeros((n, n))
    for s, d in pairs:
        m[at[d], at[s]] += 1.0
    deg = m.sum(axis=0)
    dangling = deg == 0
    w = np.divide(m, deg, out=np.zeros_like(m), where=~dangling)
    r = np.full(n, 1.0 / n)
    for _ in range(iterations):
        r = alpha / n + (1 - alpha) * (r[dangling].sum() / n + w @ r)
    return dict(zip(ids, r))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    import random

    rnd = random.Random(seed)
    nv = rnd.randrange(5, 40)
    pairs = [(f"v{rnd.randrange(nv)}", f"v{rnd.randrange(nv)}") for _ in range(rnd.randrange(10, 200))]
    pages = [f"v{rnd.randrange(nv + 10)}" for _ in range(5)]      # some pages without links
    got = as_dict(rank_nodes(edges_graph(spark, pairs, pages), split=rnd.choice([1, 2, 1000]),
                             partitions=rnd.choice([1, 3, 8])))
    want = brute_force(pairs, pages)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-13)


def test_bucket_count_follows_edge_count():
    from linkgraph.operators.rank import bucket_count

    assert bucket_count(0, 8) == 1
    assert bucket_count(100_000, 8) == 1              # a small graph: one bucket
    assert bucket_count(1_000_000, 8) == 4            # spread over cores, ≥ 256 k edges each
    assert bucket_count(100_000_000, 8) == 12         # ~8 M edges per bucket
    assert bucket_count(10**12, 2000) == 119210


def test_sized_shuffles_raises_and_restores(spark):
    from linkgraph.session import sized_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with sized_shuffles(spark, 100):
        assert spark.conf.get(key, None) == before     # small job: untouched
    with sized_shuffles(spark, 100 * (2 << 20)):
        assert spark.conf.get(key) == "100"
    assert spark.conf.get(key, None) == before


def test_rank_step_scalar_subquery_delta_matches_measured(wiki14):
    from linkgraph.operators import rank as R

    prep = R.prepare_graph(wiki14.graph)
    n = float(prep.n_nodes)
    r0 = R.initial_ranks(prep, n).checkpoint()
    measured = R.dangling_mass(r0).first()["dangling_mass"]
    assert measured == pytest.approx(6 / 11, abs=1e-15)     # six dangling vertices of eleven
    via_subquery = {r.vid: r.rank for r in R.rank_step(prep, r0, n).collect()}
    via_literal = {r.vid: r.rank for r in R.rank_step(prep, r0, n, delta=measured).collect()}
    assert via_subquery == pytest.approx(via_literal, abs=1e-15)
    assert sum(via_subquery.values()) == pytest.approx(1.0, abs=1e-12)
    prep.release()


def test_raised_initial_partitions_give_same_ranks(wiki14, monkeypatch):
    import linkgraph.session as session

    whole = as_dict(rank_nodes(wiki14.graph))
    monkeypatch.setattr(session, "ROWS_PER_SHUFFLE_PARTITION", 1)   # ask for one partition per row
    raised = as_dict(rank_nodes(wiki14.graph))
    for k in whole:
        assert raised[k] == pytest.approx(whole[k], abs=1e-15)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert wiki14.graph.edges.sparkSession.conf.get(key, None) is None    # restored


def test_ingest_gives_a_links_hint(wiki14):
    # 16 raw anchors in scope on accepted pages bound the 13 links from above
    assert wiki14.graph.links_hint == 16


def test_parameters_are_checked(wiki14):
    from linkgraph.operators import rank as R

    prep = R.prepare_graph(wiki14.graph)
    with pytest.raises(ValueError):
        R.run_rank(prep, alpha=1.5)
    with pytest.raises(ValueError):
        R.run_rank(prep, iterations=-1)
    with pytest.raises(ValueError):
        R.run_rank(prep, n="pages")
    with pytest.raises(ValueError):
        top_k(prep.named(R.initial_ranks(prep, 11.0)), -1)
    assert R.run_rank(prep, iterations=0).iterations == 0
    prep.release()
