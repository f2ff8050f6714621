import random
from collections import defaultdict
from fractions import Fraction

import pytest

import brute
from linkgraph.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies int, t double"


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1, 0.5) for d in docs], SCHEMA)


def documents(rng, n, sources):
    return [(i, " ".join(["w"] * rng.randrange(0, 40)) + rng.choice(["", "\n", "\x85"]), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("sources", [["a"] * 20 + ["b", "é", "z"], ["a", "b"], ["a"] * 8 + [None, "B", "", "𝕏", "￿"]])
def test_plan_equals_brute_force(spark, sources):
    docs = documents(random.Random(len(sources)), 300, sources) + [(500, None, sources[-1]), (501, "", "empty"), (None, "w w", sources[0])]
    got = mixing.plan(frame(spark, docs), bucket_rows=10).collect()
    rows = sorted((repr((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])) for r in got))
    assert rows == sorted(map(repr, brute.mix(docs)))
    taken = defaultdict(int)
    for r in got:
        assert sum(c["words"] for c in r["copies"]) == r["taken"] <= 3 * r["size"]
        taken[r["source"], r["target"]] += r["taken"]
    assert all(abs(n - target) < 1 for (_, target), n in taken.items())


@pytest.mark.parametrize("weights,most", [((5, 2, 1), 3), ((7, 3), 2), ((1,), 1)])
@pytest.mark.parametrize("sizes", [[3 ** i for i in range(30)], [1] * 200 + [10 ** 6], [0] * 40, [5, 0, 0, 10 ** 15, 7], []])
def test_targets_equal_rounds_of_capping(spark, sizes, weights, most):
    sources = [(f"s{i:04d}", n) for i, n in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(sources, "source string, source_size long"), weights, most).collect()
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(sources)}
    size, capped = dict(sources), set()
    while True:  # cap what lies above the level, share the rest anew, until nothing does
        rest = sum(sizes) - sum(most * size[s] for s in capped)
        left = sum(weight[s] for s in size if s not in capped)
        more = {s for s in size if s not in capped and most * size[s] < Fraction(weight[s] * rest, max(left, 1))}
        if not more:
            break
        capped |= more
    want = {s: float(most * size[s]) if s in capped else float(weight[s] * rest) / float(max(left, 1)) for s in size}
    assert {r["source"]: r["target"] for r in got} == want


def test_positions_follow_demand(spark):
    docs = documents(random.Random(1), 600, ["a", "b", "c"])
    rows = [(c["t"], c["words"], r["source"], r["target"]) for r in mixing.plan(frame(spark, docs)).collect() for c in r["copies"]]
    for source, knots in zip("abc", mixing.SCHEDULES):
        own = sorted((t, n) for t, n, s, _ in rows if s == source)
        target = next(x[3] for x in rows if x[2] == source)
        seen = 0
        for t, n in own:  # words before t: the schedule's integral up to t
            demand = 0.0
            for t0, t1, w0, w1, done in mixing.integral(knots):
                if t0 <= t <= t1:
                    x = t - t0
                    demand = done + w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            assert abs(seen - demand * target) < 1e-6 * target + 1e-6
            seen += n


def test_mixed_documents(spark):
    docs = documents(random.Random(2), 200, ["a"] * 9 + ["b"])
    docs += [(7, docs[7][1], docs[7][2])]  # a repeated row
    df = frame(spark, docs)
    out = mixing.mixed_documents(df)
    assert out.schema == df.schema
    rows, plan = out.collect(), mixing.plan(df).collect()
    want = sorted((c["t"], r["doc_id"], c["words"]) for r in plan for c in r["copies"])
    assert sorted((r["doc_id"], len(brute.words(r["text"]))) for r in rows) == sorted((d, n) for _, d, n in want)
    assert [r["doc_id"] for r in rows if r["doc_id"] != 7] == [d for _, d, _ in want if d != 7] or len({t for t, *_ in want}) < len(want)
    texts = defaultdict(set)
    for d, t, _ in docs:
        texts[d].add(t)
    assert all(any(t.startswith(r["text"]) for t in texts[r["doc_id"]]) for r in rows)
    cut = [r for r in rows if r["text"] not in texts[r["doc_id"]]]
    assert len(cut) <= 2  # the copy that crosses a source's target


def test_no_rows_and_no_words(spark):
    assert mixing.plan(frame(spark, [])).collect() == [] and mixing.mixed_documents(frame(spark, [])).collect() == []
    got = mixing.plan(frame(spark, [(1, " ", "a"), (2, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"], r["copies"]) for r in got] == [(0, 0.0, 0, [])] * 2


def test_reruns_agree(spark):
    docs = frame(spark, documents(random.Random(3), 100, ["a", "b"]))
    first, again = ([tuple(r) for r in mixing.mixed_documents(d).collect()] for d in (docs, docs.repartition(7)))
    assert first == again
