"""Preparation by blocks: names to numbers, links to target lists."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkgraph.operators import blocks as B
from linkgraph.operators import rank as R
from linkgraph.operators.graph import Graph

LINKS = "src string, dst string, mult bigint"


def some_links(n=3000, seed=1):
    """Links with repeats, self-links, a hub at either end, and odd names."""
    rnd = random.Random(seed)
    names = ["", "é", "中文", "h7", "v7", *(f"v{i}" for i in range(300))]
    pairs = [("hub" if rnd.random() < 0.3 else rnd.choice(names), "sink" if rnd.random() < 0.3 else rnd.choice(names)) for _ in range(n)]
    return [*pairs, *[("hub", "sink")] * n, ("a", "a")]


def laid_out(prep):
    """The vertices by name and the links ``{(src, dst): (w, bucket)}`` of a preparation."""
    nodes = {r["id"]: r for r in prep.nodes.collect()}
    assert len(nodes) == prep.n_nodes and sorted(r["vid"] for r in nodes.values()) == list(range(prep.n_nodes))
    ids = {r["vid"]: r["id"] for r in nodes.values()}
    rows = [(ids[r["src_vid"]], ids[int(t)], r["w"], r["bucket"]) for r in prep.wedges.collect() for t in np.frombuffer(r["dst_vids"], "<i8")]
    links = {(s, d): (w, b) for s, d, w, b in rows}
    assert len(links) == len(rows) == prep.n_pairs
    prep.release()
    return nodes, links


def check(nodes, links, mult, pages=(), split=R.DEFAULT_SPLIT):
    out, to, met = Counter(), Counter(), Counter()
    for (s, d), m in mult.items():
        out[s] += m
        to[s] += 1
        met[d] += 1
    assert nodes.keys() == out.keys() | met.keys() | set(pages)
    for v, r in nodes.items():
        assert (r["out_degree"], r["n_targets"], r["n_sources"], r["nb"]) == (out[v], to[v], met[v], -(-to[v] // split))
        assert r["dangling"] == (v not in out) and r["is_page"] == (v in out or v in pages)
    assert {k: w for k, (w, _) in links.items()} == {(s, d): m / out[s] for (s, d), m in mult.items()}
    assert all(0 <= b < nodes[s]["nb"] for (s, _), (_, b) in links.items())


@pytest.mark.parametrize("hot", [False, True])
def test_links_are_numbered_without_a_join_by_name(spark, monkeypatch, hot):
    monkeypatch.setattr(R, "_with_vids", lambda *a: 1 / 0)
    monkeypatch.setattr(R, "MIN_LINKS_PER_BLOCK", 500)
    if hot:
        monkeypatch.setattr(R, "HOT_VERTICES", 50)
        monkeypatch.setattr(R, "MIN_HOT_LINKS", 20)
    pairs = some_links()
    pages = spark.createDataFrame([("alone",), ("a",), (None,)], "id string")
    graph = Graph(spark.createDataFrame([*pairs, (None, "a"), ("a", None)], "src string, dst string").repartition(3), pages)
    check(*laid_out(R.prepare_graph(graph, split=7)), Counter(pairs), ("alone", "a"), 7)


def test_weighted_and_merged_links(spark):
    rnd = random.Random(2)
    rows = [(f"v{rnd.randrange(40)}", f"v{rnd.randrange(40)}", rnd.choice([1, 2, 300])) for _ in range(500)]
    mult = Counter()
    for s, d, m in rows:
        mult[s, d] += m
    check(*laid_out(R.prepare_graph(Graph(spark.createDataFrame(rows, LINKS)))), mult)
    merged = spark.createDataFrame([(s, d, m) for (s, d), m in mult.items()], LINKS)
    check(*laid_out(R.prepare_graph(Graph(merged, merged=True))), mult)


def test_names_of_one_key_are_told_apart(spark, monkeypatch):
    pairs = some_links(400, seed=3)
    graph = Graph(spark.createDataFrame(pairs, "src string, dst string"), spark.createDataFrame([("alone",)], "id string"))
    monkeypatch.setattr(R, "name_key", lambda name: F.xxhash64(F.substring(name, 1, 2)))
    check(*laid_out(R.prepare_graph(graph, split=7)), Counter(pairs), ("alone",), 7)


def test_names_need_not_be_strings(spark):
    pairs = [(1, 2), (2, 3), (1, 3), (1, 3)]
    check(*laid_out(R.prepare_graph(Graph(spark.createDataFrame(pairs, "src bigint, dst bigint")))), Counter(pairs))


def test_links_of_a_hot_vertex_go_to_all_blocks():
    rnd, blocks, n = np.random.default_rng(5), 16, 40_000
    src, dst = rnd.integers(-1 << 62, 1 << 62, n), rnd.integers(-1 << 62, 1 << 62, n)
    dst[: n * 6 // 10] = 77
    src[: n // 4] = 88                           # one link, ever repeated
    rows = pa.RecordBatch.from_pydict({"a": [src.tobytes()], "b": [dst.tobytes()], "c": pa.nulls(1, pa.binary())})
    hot = B.Hot(np.array([77], np.uint64), np.array([5]))
    moved = [r for b in B.links_by_target(blocks, hot)(iter([rows])) for r in b.to_pylist()]
    sizes = Counter()
    for r in moved:
        sizes[r["block"]] += len(r["a"]) // 8
    assert sum(sizes.values()) == n - n // 4 + 1 and len(sizes) == blocks
    assert max(sizes.values()) <= 2 * n / blocks
    assert sum(B._repeats([r["a"] for r in moved], [r["c"] for r in moved])) == n
