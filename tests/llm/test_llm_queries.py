"""Every llm query on the smallest tables, against SQL or brute force."""

import os
import sys

import pytest

import brute

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", ".."))

import corpus_pipeline  # noqa: E402
import sentencepiece  # noqa: E402
from compare import compare, duck  # noqa: E402
from linkgraph.llm.common import saved, saved_tables_removed  # noqa: E402
from linkgraph.llm.oracle import ORACLE  # noqa: E402
from linkgraph.llm.queries import QUERIES, op4_quality_rules, op6_simhash, tokenizer_path  # noqa: E402
from linkgraph.session import checkpoint_root  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    problems, n, _, _ = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert not problems and n > 0


def fitted(spark, sf, documents):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return brute.fit_bands([(d, t) for d, t, _ in documents], labels)


def test_quality_query(spark):
    """On all of sf0.01, where most classes have clean texts enough to be fitted."""
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"], None) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bands = fitted(spark, sf, docs)
    assert sum(a != b for a, b in zip(bands[0], brute.WIDE[0])) >= 4 and bands[1] != brute.WIDE[1]
    got = sorted(tuple(r) for r in op4_quality_rules(spark, sf).collect())
    assert got == sorted((d, *brute.quality(t, bands)) for d, t, _ in docs)


def test_simhash_query(spark, documents):
    got = sorted(tuple(r) for r in op6_simhash(spark, SF).collect())
    assert got == sorted(brute.near_duplicates([(d, t) for d, t, _ in documents]))


def _folder(spark):
    return checkpoint_root(spark).removeprefix("file:")


def test_saved_tables_are_removed_on_errors_too(spark):
    before = set(os.listdir(_folder(spark)))
    kept = saved(spark.range(3).toDF("id"), "outside")
    with pytest.raises(ValueError), saved_tables_removed(spark):
        assert saved(spark.range(5).toDF("id"), "inside").count() == 5
        raise ValueError
    (left,) = set(os.listdir(_folder(spark))) - before
    assert left.startswith("outside-") and kept.count() == 3


def test_pipeline(spark, documents):
    bands = fitted(spark, SF, documents)
    docs = [d for d in documents if brute.quality(d[1], bands)[-1]]
    source = {d: s for d, _, s in docs}
    docs = [(d, t, source[d]) for d, t, _ in brute.line_dedup(docs, 8)]
    docs = [x for x, (d, _, first) in zip(docs, brute.near_duplicates([x[:2] for x in docs])) if d == first]
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    text = {d: t for d, t, _ in docs}
    want = []
    for d, size, _, _, taken in brute.mix(docs):
        ids = model.encode(text[d], add_bos=True, add_eos=True)
        want += [(d, len(ids), ids)] * (taken // size if size else 0)
        if size and taken % size:
            spans = list(brute.WORD.finditer(text[d]))
            cut = model.encode(text[d][:spans[taken % size - 1].end()], add_bos=True, add_eos=True)
            want.append((d, len(cut), cut))
    before = set(os.listdir(_folder(spark)))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(want)
    (left,) = {d for d in os.listdir(_folder(spark)) if not d.startswith("rdd-")} - before
    assert left.startswith("pipeline-source_mix-")  # what the lazy result reads; all else is removed


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, empty):
            out = stage(spark, df, SF)
            assert out.dtypes == docs.dtypes
    assert stage(spark, empty, SF).count() == 0
