import random

import numpy as np
import pytest

import brute
from linkgraph.llm import substrings
from linkgraph.llm.common import run_hashes, word_hashes

SCHEMA = "doc_id long, text string, th string, ref int, seeds int"


def run(spark, docs, **options):
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], SCHEMA)
    return sorted((tuple(r)[:1] + tuple(r)[2:] for r in substrings.changed_documents(df, **options).collect()), key=repr)


def expected(docs, window):
    return sorted({r for r in brute.substring_dedup(docs, window) if r[2]}, key=repr)


def shuffled_passages(rng, n, letters="abcdefghij"):
    """Documents pasted together from shared passages, with edits."""
    passages = [[rng.choice(letters) + rng.choice(letters) for _ in range(rng.randrange(3, 40))] for _ in range(12)]
    docs = []
    for _ in range(n):
        w = []
        for _ in range(rng.randrange(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.7 else [rng.choice(letters) for _ in range(rng.randrange(0, 20))]
        if w and rng.random() < 0.5:
            w[rng.randrange(len(w))] = "edit"
        docs.append((" " if rng.random() < 0.5 else "\n").join(w))
    return docs


@pytest.mark.parametrize("seed,window,anchor,block", [(1, 8, 3, 8), (2, 6, 2, 16), (3, 12, 5, 4)])
def test_equals_brute_force(spark, seed, window, anchor, block):
    rng = random.Random(seed)
    docs = list(enumerate(shuffled_passages(rng, 150)))
    rng.shuffle(docs)
    docs = [(d - 20, t) for d, t in docs]  # negative ids too
    assert run(spark, docs, window=window, anchor=anchor, block=block) == expected(docs, window)


def test_low_complexity(spark):
    docs = [(i, t) for i, t in enumerate(["a " * 30, "a " * 9, "b a " * 20, "a b " * 20, "a " * 7 + "b", "c" + " a" * 12])]
    assert run(spark, docs, window=8, anchor=3, block=8) == expected(docs, 8)


def test_third_document_behind_a_factor_boundary(spark):
    """c shares its passage's middle with a, but its ends with b only."""
    mid, left, right = [f"m{i}" for i in range(30)], [f"l{i}" for i in range(40)], [f"r{i}" for i in range(40)]
    docs = [(1, " ".join(["x"] * 5 + mid + ["y"] * 60)), (2, " ".join(left + mid + right)), (3, " ".join(["q"] + left + mid + right + ["z"]))]
    got = run(spark, docs)
    assert got == expected(docs, 50) and got[0][:3] == (3, 112, 110)


def test_copies_nulls_and_repeated_rows(spark):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(200)) for _ in range(3)]
    docs = [(5, base[0]), (6, base[0]), (6, base[0]), (6, base[1]), (7, base[1]), (None, base[0]), (8, None), (9, ""), (10, " \n"),
            (11, base[2] + " é " + base[0])]
    assert run(spark, docs) == expected(docs, 50)
    assert run(spark, []) == []


def test_remove_repeats_keeps_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "x", 1, 2), (2, text + "  tail", "y", None, 2), (None, text, None, 1, 2), (4, "two\nwords", "x", 1, 2)]
    out = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "th", "ref", "seeds"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(
        [rows[0], (2, "tail", "y", None, 2), rows[2], rows[3]], key=repr)


def test_hashes_depend_on_words_only():
    text = "  one two\tthree\x0bone  two three\x85four ".encode()
    start, end, hashes = word_hashes(text)
    assert [text[a:b] for a, b in zip(start, end)] == text.split()
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 4
    assert run_hashes(hashes, 2)[0] == run_hashes(hashes, 2)[3]
    assert len(word_hashes(b"")[2]) == len(word_hashes(b" \n")[2]) == 0


def test_long_text_anchors():
    words = np.random.default_rng(0).integers(0, 2**63, 60_000, dtype=np.uint64)
    position, _, first, last = substrings.anchors(words)
    assert first[0] == 0 and last[-1] == len(words) - 50 and np.array_equal(first[1:], last[:-1] + 1)
    assert np.all((position >= first) & (position <= last + 34))
