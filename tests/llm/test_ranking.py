import math
import random
import re
from collections import Counter

import pytest

from linkgraph.llm import ranking

SCHEMA = "doc_id long, text string, item_id string, rank int"


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if text else []


def brute(docs, items, k):
    held = [(d, Counter(tokens(t))) for d, t in docs if d is not None]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m))
                        for w in tokens(text) if w in c)
            if score > 0:
                scores.append((-score, d))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items, k=5, limit=200_000, **blocks):
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    asked = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id int")
    found = ranking.search(ranking.build_index(rows, **blocks), asked, k, limit)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def corpus(n, seed):
    """Words of very unlike frequency, some documents very long, many alike."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "Été", "a_b"]
    weight = [200 / (i + 1) for i in range(60)] + [300, 300, 5, 5]
    docs = [(i, " ".join(rng.choices(words, weight, k=rng.choice((0, 3, 8, 30, 300))))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(40)]
    return docs, [(j, " ".join(rng.choices(words, k=rng.randrange(12)))) for j in range(25)]


@pytest.mark.parametrize("blocks,limit", [({}, 200_000), ({"block_docs": 7}, 200_000), ({"block_postings": 60}, 10)])
def test_equals_brute_force(spark, blocks, limit):
    docs, items = corpus(250, 3)
    assert run(spark, docs, items, 5, limit, **blocks) == brute(docs, items, 5)


def scanner(spark, docs):
    """The only block of an index of ``docs``, with every term of it as vocabulary."""
    import pyarrow as pa

    index = ranking.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    row = index.toArrow().to_batches()[0]
    values = {n: row.column(n)[0] for n in row.schema.names}
    values = {n: v.values if isinstance(v, pa.ListScalar) else v.as_py() for n, v in values.items()}
    return ranking.Scanner(values, values["terms"], values["n_docs"], values["n_terms"], 2), values["terms"].to_pylist(), values["held"].to_pylist()


def test_no_accumulators_once_the_rest_cannot_reach_the_kth(spark, monkeypatch):
    """The frequent word's postings are not walked: only the survivors are looked up."""
    docs = [(i, "the " * 3 + ("rare rare rare" if i < 3 else f"x{i}")) for i in range(500)]
    block, terms, held = scanner(spark, docs)
    walked = []
    impact = ranking.impact
    monkeypatch.setattr(ranking, "impact", lambda tf, m: walked.append(len(tf)) or impact(tf, m))
    import numpy as np
    numbers = np.array([terms.index("rare"), terms.index("the")])
    weights = np.array([5000, 1])
    ids, scores = block.top(ranking.Query(0, 0, numbers, weights, np.array([1, 1])), 1)
    assert sorted(ids) == [0, 1, 2] and walked == [3, 3]
    want = 5000 * impact(np.array([3]), block.m[:1])[0] + impact(np.array([3]), block.m[:1])[0]
    assert set(scores) == {want}


def test_nulls_repeats_and_empty_tables(spark):
    docs = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "a a a"), (4, "c " * 50_000 + "a"), (5, "."), (6, "A")]
    items = [(1, "a"), (1, "a b"), (None, "c"), (2, None), (3, ""), (4, "zzz"), (5, "a a a b")]
    assert run(spark, docs, items, 3) == brute(docs, items, 3)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_length_factor_beyond_64_bits():
    import numpy as np
    assert ranking.length_factor(np.array([10 ** 12, 1]), 10 ** 12, 10 ** 13).tolist() == [75 + 25 * 10 ** 11, 75 + 2]


def test_tasks_get_few_texts_and_one_block_at_a_time(spark, monkeypatch):
    """However large the batches of the session are: a block of the index takes megabytes."""
    frame = type(spark.range(0))
    handed = frame.mapInArrow

    def limited(df, f, schema):
        most = 1 if "tfs" in df.columns else 500

        def run(parts):
            def seen():
                for part in parts:
                    if part.num_rows > most:
                        raise ValueError(f"{part.num_rows} rows at once")
                    yield part
            return f(seen())

        return handed(df, run, schema)

    monkeypatch.setattr(frame, "mapInArrow", limited)
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(x, None) for x in names]
    docs = [(i, f"a w{i % 9}") for i in range(1300)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    items = [(0, "a w1"), (1, "w3")]
    index = ranking.build_index(rows, block_docs=100)
    found = ranking.search(index, spark.createDataFrame(items, "item_id long, text string"), 5)
    assert index.count() == 13 and sorted(tuple(r) for r in found.collect()) == brute(docs, items, 5)
    assert [spark.conf.get(x, None) for x in names] == before
