import itertools
import os
import random

import numpy as np
import pytest

import brute
from linkgraph.llm import simhash
from linkgraph.llm.components import components
from linkgraph.session import checkpoint_root

SCHEMA = "doc_id long, text string, fp string, bucket int, root int"


def run(spark, docs, **options):
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], SCHEMA)
    rows = simhash.near_duplicates(df, **options).collect()
    return sorted(((r["doc_id"], f"{r['fp'] % (1 << 64):016x}", r["component_id"]) for r in rows), key=repr)


def varied(rng, n):
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(n)]
    for _ in range(n):  # near copies: one word changed
        w = rng.choice(texts).split(" ")
        w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    return texts


def test_masks_make_every_close_pair_collide():
    for option in (2**64 - 1, (1 << 11) - 1, 0b1011):
        tables = simhash.masks(option, 2)
        bits = [b for b in range(64) if option >> b & 1]
        for pair in itertools.combinations(bits, 2):
            diff = sum(1 << b for b in pair)
            assert any(not diff & m for m in tables)
        assert all(any(not 1 << b & m for m in tables) for b in bits)


@pytest.mark.parametrize("bucket_rows", [2000, 2])
def test_equals_brute_force(spark, bucket_rows):
    rng = random.Random(3)
    docs = list(enumerate(varied(rng, 120)))
    docs += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "é É two words")]
    docs += [(2000 + i, docs[5][1]) for i in range(30)] + [(2000, docs[5][1])]  # copies, and a repeated row
    assert run(spark, docs, bucket_rows=bucket_rows) == sorted(brute.near_duplicates(docs), key=repr)


def test_dense_fingerprints_split_their_bucket(spark):
    fps = [0] + [1 << b for b in range(64)] + [(1 << b) | 7 << 40 for b in range(20)]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.fingerprint_links(df, 2, 4)
    label = {r["id"]: r["root"] for r in components(links).collect()}
    expect = brute.clusters(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = [label.get(s, s) for s in signed]
    assert [[a == b for a in got] for b in got] == [[a == b for a in expect] for b in expect]


def test_fingerprint_of_long_text():
    text = " ".join(f"w{i % 997}" for i in range(150_000))
    assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


def test_bucket_links_span_components():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 12, 300).astype(np.int64))
    links = simhash.bucket_links(fps)
    root = brute.clusters(len(fps), lambda i, j: int(fps[i] ^ fps[j]).bit_count() <= 2)
    again = brute.clusters(len(fps), lambda i, j: (i, j) in set(links) or (j, i) in set(links))
    assert root == again and len(links) == len(fps) - len(set(root))


def test_null_ids_and_empty(spark):
    assert run(spark, []) == []
    got = run(spark, [(None, "same words in here"), (7, "same words in here"), (None, "others all alone now"), (None, "others all alone now")])
    assert [g[2] for g in sorted(got, key=lambda g: (g[1], repr(g[0])))].count(None) == 2
    assert sum(g[2] == 7 for g in got) == 2


def test_drop_keeps_one_of_each_group(spark):
    docs = [(3, "a b c d", "x", 1, 2), (1, "a b c d", "x", 1, 2), (2, "other text here", "x", 1, 2), (5, None, None, None, None),
            (3, "its own text though", "x", 1, 2)]  # an id twice: one text is a copy, one is not
    kept = simhash.drop_near_duplicates(spark.createDataFrame(docs, SCHEMA))
    assert kept.columns == ["doc_id", "text", "fp", "bucket", "root"]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [
        (1, "a b c d"), (2, "other text here"), (3, "its own text though"), (5, None)]


def test_drop_keeps_one_row_of_null_ids_repeated_rows_and_shared_ids(spark):
    docs = [(None, "null id copies here", "x", i, 2) for i in range(50)] + [(None, "NULL id copies here", "x", 1, 2)]
    docs += [(None, "another null id text", "x", 1, 2)] * 3 + [(7, "the same row again", "x", 1, 2)] * 20 + [(8, "the same row again", "x", 1, 2)]
    docs += [(9, "linked texts of one id", "x", 1, 2), (9, "Linked Texts of one id", "x", 1, 2), (10, "LINKED texts of one id", "x", 1, 2)]
    docs += [(None, "an id goes before null", "x", 1, 2), (11, "an id goes before null", "x", 1, 2)]
    df = spark.createDataFrame(docs, SCHEMA).withColumnRenamed("root", "__row").repartition(5)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"].lower()) for r in kept.collect()), key=repr) == sorted([
        (None, "null id copies here"), (None, "another null id text"), (7, "the same row again"), (9, "linked texts of one id"),
        (11, "an id goes before null")], key=repr)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 400), (400, 450)]
    rng.shuffle(links)
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(40)}, 400: 400, 450: 400, 500: 400}
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_components_leave_one_round(spark):
    folder = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "src long, dst long")
    got = {r["id"]: r["root"] for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert [d.split("-")[0] for d in set(os.listdir(folder)) - before] == ["components"]
