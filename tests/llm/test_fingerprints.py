import hashlib
import random

import pytest
from pyspark.sql import functions as F

import brute
from linkgraph.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, sketch string, r int, k string, extra int"


def shingles(text, width=5):
    w = brute.words(text)
    return {hashlib.md5(" ".join(w[i:i + width]).encode()).hexdigest()[:16] for i in range(max(len(w) - width + 1, 1))} if w else set()


def sketch(text, k):
    return sorted(shingles(text))[:k]


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in docs], SCHEMA)


def corpus(n, seed, most=400):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices([f"w{j}" for j in range(300)], k=rng.choice((0, 1, 4, 5, 6, 50, most))))) for i in range(n)]


@pytest.mark.parametrize("k", [1, 8, 128])
def test_fingerprint_equals_brute_force(spark, k):
    docs = corpus(60, 1) + [(99, "é" * 3 + "\n\tb\x0bc d e f g"), (100, None), (101, " \n"), (102, "a " * 9000)]
    got = frame(spark, docs).select("doc_id", fp.fingerprint(F.col("text"), k).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in got} == {d: sketch(t, k) for d, t in docs}


def test_long_texts_in_parts(spark):
    docs = corpus(3, 2, most=20_000)
    docs = [(0, docs[0][1]), (1, " ".join(str(i * 7919 % 10007) for i in range(30_000)))]
    got = frame(spark, docs).select(fp.fingerprint(F.col("text"), 16).alias("s")).collect()
    assert [r["s"] for r in got] == [sketch(t, 16) for _, t in docs]


def test_parts_merge_to_the_whole(spark):
    docs = corpus(80, 3)
    rows = frame(spark, docs).select((F.col("doc_id") % 3).alias("g"), fp.fingerprint(F.col("text"), 32).alias("s"))
    rows = rows.unionByName(rows.where("g = 0").withColumn("g", F.lit(None).cast("long")))
    got = {r["g"]: r["s"] for r in fp.merged(rows, "g", "s", 32).collect()}
    for g in (0, 1, 2):
        assert got[g] == sorted(set().union(*(shingles(t) for d, t in docs if d % 3 == g)))[:32]
    assert got[None] == got[0]


def test_estimates(spark):
    words = [str(i) for i in range(5000)]
    docs = [(0, " ".join(words)), (1, " ".join(words[:4000])), (2, " ".join(words[1000:])), (3, ""), (4, "a b"), (5, " ".join(words[:60]))]
    rows = frame(spark, docs).select("doc_id", fp.fingerprint(F.col("text")).alias("s"))
    pairs = rows.alias("a").join(rows.alias("b"), F.lit(True)).select(
        F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"), fp.resemblance(F.col("a.s"), F.col("b.s")).alias("r"),
        fp.containment(F.col("a.s"), F.col("b.s")).alias("c"), fp.distinct_shingles(F.col("a.s")).alias("n"))
    got = {(r["x"], r["y"]): r for r in pairs.collect()}
    true = {d: shingles(t) for d, t in docs}
    for (x, y), r in got.items():
        a, b = true[x], true[y]
        assert abs(r["r"] - (len(a & b) / len(a | b) if a | b else 1)) < 0.13
        if len(a | b) <= 128:
            assert r["c"] == (len(a & b) / len(a) if a else 1)
        assert r["n"] == len(a) if len(a) < 128 else abs(r["n"] / len(a) - 1) < 0.3
    assert got[0, 0]["r"] == got[3, 3]["r"] == 1 and got[3, 0]["r"] == 0 and got[1, 0]["c"] == 1


@pytest.mark.parametrize("range_rows", [1, 3, 1000])
def test_next_document(spark, range_rows):
    docs = [(d * 3 % 101, t) for d, t in corpus(101, 4, 30)]
    got = {r["doc_id"]: r["next_text"] for r in fp.with_next(frame(spark, docs).repartition(4), F.length, range_rows).collect()}
    order = sorted(docs)
    assert got == {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}


@pytest.mark.parametrize("range_rows", [1, 2, 1000])
def test_next_of_repeats_and_nulls(spark, range_rows):
    docs = [(1, "b"), (2, "c")] * 5 + [(None, "n")] * 4 + [(3, None)]
    rows = fp.with_next(frame(spark, docs), F.length, range_rows).collect()
    got = sorted((str(r["doc_id"]), r["text"], r["next_text"]) for r in rows)
    assert got == sorted([("1", "b", "b")] * 4 + [("1", "b", "c")] + [("2", "c", "c")] * 4 + [("2", "c", "")]
                         + [("3", "", "n")] + [("None", "n", "n")] * 3 + [("None", "n", "b")])


def test_edits(spark):
    docs = [(1, "abcdefgh"), (2, "x"), (3, None), (4, "é日本語 und mehr"), (5, "12345678901")]
    got = {r["doc_id"]: r["edited"] for r in fp.with_edits(frame(spark, docs)).collect()}
    assert got == {1: "abcdefx", 2: "x", 3: "", 4: "é日本語 und m123", 5: "123456789ab"}
    assert [r["edited"] for r in fp.with_edits(frame(spark, docs[:1])).collect()] == ["abcdefab"]
    assert fp.with_edits(frame(spark, [])).collect() == []


def test_main_path_is_native(spark):
    plan = fp.with_edits(frame(spark, corpus(20, 5)))._jdf.queryExecution().toString()
    plan += fp.merged(frame(spark, []).select("doc_id", F.array("text").alias("s")), "doc_id", "s")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval", "MapInArrow"))
