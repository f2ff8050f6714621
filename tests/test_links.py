"""Links inside tasks: target lists, and sums by target."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linkgraph.operators import links as L
from linkgraph.operators import rank as R
from linkgraph.operators.graph import Graph


def batches(columns, rows, size):
    return [pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows[a:a + size])], columns) for a in range(0, len(rows), size)]


def rows_of(found):
    return [tuple(r.values()) for b in found for r in b.to_pylist()]


@pytest.mark.parametrize("base", [0, 1 << 60])      # numbers that fit one sort key with a place, and such that do not
@pytest.mark.parametrize("cut", [1, 50, 1 << 22])
def test_lists_hold_every_link_and_sums_every_share(monkeypatch, base, cut):
    monkeypatch.setattr(L, "LINKS_AT_ONCE", cut)
    monkeypatch.setattr(L, "LINKS_OUT", 7)
    rnd = random.Random(5)
    links = [(base + rnd.randrange(9), rnd.randrange(2), base + rnd.randrange(30), rnd.choice([0.25, 0.5])) for _ in range(400)]
    lists = list(L.link_lists(iter(batches(["src_vid", "bucket", "dst_vid", "w"], links, 33))))
    got = Counter((s, b, int(t), w) for s, b, w, targets in rows_of(lists) for t in np.frombuffer(targets, "<i8"))
    assert got == Counter(links)
    shares = [(targets, int(w * 8) << 50, s - base) for s, _, w, targets in rows_of(lists)]
    sums = Counter()
    for vid, u, f in rows_of(L.sums_by_target(iter(batches(["dst_vids", "u", "f"], shares, 4)))):
        sums[vid, "u"] += u
        sums[vid, "f"] += f
    want = Counter()
    for s, _, t, w in links:
        want[t, "u"] += int(w * 8) << 50
        want[t, "f"] += s - base
    assert sums == want
    named = [(f"s{s}", w, targets) for s, _, w, targets in rows_of(lists)]
    apart = rows_of(L.links_of_lists(iter(batches(["src", "c", "dst_vids"], named, 5))))
    assert Counter(apart) == Counter((f"s{s}", w, t) for s, _, t, w in links)


def test_no_rows_in_no_rows_out():
    assert not list(L.link_lists(iter([]))) and not list(L.sums_by_target(iter([])))


def test_a_round_joins_a_row_per_list_not_per_link(spark):
    rnd = random.Random(3)
    pairs = [(f"v{rnd.randrange(20)}", f"v{rnd.randrange(400)}") for _ in range(3000)]
    prep = R.prepare_graph(Graph(spark.createDataFrame(pairs, "src string, dst string")))
    rows = prep.wedges.collect()
    assert sum(len(r["dst_vids"]) for r in rows) == 8 * len(set(pairs)) == 8 * prep.n_pairs
    # at most one row per source, number of repeats and task
    assert len(rows) < prep.n_pairs / 5
    ids = {r["vid"]: r["id"] for r in prep.nodes.collect()}
    degree = Counter(s for s, _ in pairs)
    got = {(ids[r["src_vid"]], ids[int(t)]): r["w"] for r in rows for t in np.frombuffer(r["dst_vids"], "<i8")}
    assert got == {(s, d): m / degree[s] for (s, d), m in Counter(pairs).items()}
    prep.release()


def test_a_state_of_another_layout_is_an_error(spark, tmp_path, monkeypatch):
    state, graph = str(tmp_path / "s"), Graph(spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string"))
    prep = R.prepare_graph(graph, state=state)
    prep.release()
    again = R.prepare_graph(graph, state=state)
    assert again.n_pairs == 2
    again.release()
    monkeypatch.setattr(R, "LIST_SCHEMA", "src_vid bigint, bucket bigint, dst_vid bigint, w double")
    with pytest.raises(ValueError, match="another layout"):
        R.prepare_graph(graph, state=state)


@pytest.mark.parametrize("size", [1, 7, 1 << 10])
def test_shares_move_by_blocks_and_none_is_lost(size):
    rnd = random.Random(8)
    shares = [(np.array([rnd.randrange(60) for _ in range(rnd.randrange(9))], "<i8").tobytes(), rnd.randrange(1 << 50), rnd.randrange(99)) for _ in range(80)]
    own = [(v, v, 1, v % 3, v / 7) for v in rnd.sample(range(50), 50)]      # vertices of 50 and above have no row of their own
    moved = [*L.blocks_of_sums(size)(iter(batches(["dst_vids", "u", "f"], shares, 9))),
             *L.blocks_of_rows(size)(iter(batches(["vid", "u", "f", "nb", "prev"], own, 11)))]
    rnd.shuffle(moved)
    want = {v: [u, f, nb, prev] for v, u, f, nb, prev in own}
    for targets, u, f in shares:
        for t in np.frombuffer(targets, "<i8").tolist():
            row = want.setdefault(t, [0, 0, None, None])
            row[0], row[1] = row[0] + u, row[1] + f
    got = rows_of(L.rows_of_blocks(size, [("nb", "<i8"), ("prev", "<f8")])(iter(moved)))
    assert {v: row for v, *row in got} == want and len(got) == len(want)


def test_a_round_moves_a_row_per_block_not_per_share(spark, monkeypatch):
    rnd = random.Random(4)
    prep = R.prepare_graph(Graph(spark.createDataFrame([(f"v{rnd.randrange(3000)}", f"v{rnd.randrange(3000)}") for _ in range(20_000)], "src string, dst string")))
    n, size = float(prep.n_nodes), R.block_size(prep.n_nodes, spark.sparkContext.defaultParallelism)
    moved = R._moving(prep, R.initial_ranks(prep, n), R.UNIT_BITS, R.initial_ranks(prep, n).selectExpr("vid", "0L as u", "0L as f", "nb", "prev"), size)
    met = moved.rdd.getNumPartitions() * (prep.n_nodes // size + 1)
    assert moved.count() <= met < prep.n_nodes / 5
    prep.release()
