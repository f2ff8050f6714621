import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from linkgraph.llm import resampling

SCHEMA = "doc_id long, text string, score string, rank int"


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def features(text, order):
    w = tokens(text)
    return [" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, share, order=1, buckets=10_000, min_words=20):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows with unique ids."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x, order)) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for d, text in docs:
        found = features(text, order)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in found)
        rows.append((d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(tokens(text))))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], r[1]))
    place = {id(r): i + 1 for i, r in enumerate(able[:share * len(able) // 100])}
    return sorted(((*r[:4], place.get(id(r))) for r in rows), key=repr)


def run(spark, docs, target, **options):
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in resampling.resample(rows, goal, **options).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "ÉTÉ", "x_y", "A-b", "日本", "Iİ"]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("share,order", [(10, 1), (35, 2), (100, 1)])
def test_equals_brute_force(spark, share, order):
    docs, target = corpus(300, share), ["w1 w2 w3 Été été"] * 3 + [None, ""]
    assert run(spark, docs, target, share=share, order=order) == brute(docs, target, share, order)


@pytest.mark.parametrize("accuracy", [2, 10, 10_000])
def test_a_coarse_sketch_widens_the_bracket(spark, accuracy):
    docs = corpus(400, 9)
    assert run(spark, docs, ["w1 w2"], accuracy=accuracy, share=13) == brute(docs, ["w1 w2"], 13)


def test_bracket_holds_the_cutoff(spark):
    scores = spark.createDataFrame([(i // 50,) for i in range(1000)], "score long")
    for n in (1, 7, 50, 51, 500, 1000):
        low, high, above = resampling.bracket(scores, n, 1000, accuracy=100)
        want = 19 - (n - 1) // 50
        assert (low is None or low <= want) and (high is None or want <= high)
        assert above == (0 if high is None else 1000 - 50 * (high + 1)) and above < n


def test_tied_scores_go_to_the_smaller_id(spark):
    rows = [(i, 25, 25, 0, 7) for i in (5, 3, 9, 1)] + [(None, 25, 25, 0, 7), (4, 25, 25, 0, 8), (2, 5, 5, 0, 99)]
    table = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = {r["doc_id"]: r["rank"] for r in resampling.draw(table, share=70).collect()}
    assert got == {4: 1, 1: 2, 3: 3, 5: 4, 9: None, None: None, 2: None}


def test_repeated_rows_are_documents_each(spark):
    rows = [(1, 25, 25, 0, 7)] * 10 + [(2, 25, 25, 0, 3)] * 10
    table = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = [(r["doc_id"], r["rank"]) for r in resampling.draw(table, share=35).collect()]
    assert sorted(r for _, r in got if r) == list(range(1, 8)) and {d for d, r in got if r} == {1} and len(got) == 20


def test_nulls_empty_texts_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (3, " .,!"), (None, "a b"), (4, "a " * 30), (5, "b " * 100_000)]
    for target in ([], [None], ["a b c"]):
        assert run(spark, docs, target, share=50) == brute(docs, target, 50)
    assert run(spark, [], ["a"]) == []
