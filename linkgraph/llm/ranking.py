"""Ranked lexical search: accumulator-limited term-at-a-time over index blocks.

``build_index`` reads every text once and writes an inverted index in blocks: a
block is a few thousand whole documents with, for each of its terms, the
documents that hold it and how often. ``search`` reads the blocks where they
are. For each item of a block of queries it takes the item's terms rarest first
and adds each term's contributions to the documents' accumulators. As soon as
all terms that are left together cannot lift a new document to the k-th best
score so far (the k-th partial score in the block, or the item's k-th score from
the task's earlier blocks), no accumulators are created any more; those that
exist are updated to the end by looking their documents up in the postings, so
that long postings of frequent terms are not walked. Scores are whole numbers.

A term's weight and a document's length factor come from exact counts over all
documents: documents with a term, all terms, documents per term.

Scale. Index blocks are bounded by postings and documents (a document is never
split, and never larger than its text), and a task is handed one at a time, and
a few hundred texts to build them. Nothing of the corpus reaches the driver but
two counts; queries go to the tasks in blocks bounded by their
terms, each block of queries reading the index once. A task sends at most ``k``
rows per item. Document frequencies are counted per block first, then summed
for the queries' terms only.

Cases: null texts have no terms; documents without a term count nowhere and are
never returned; rows with a null ``doc_id`` take no part; repeated rows are
documents each; every row of the items is a query of its own, repeated ids and
null ids too; terms that no document holds, and terms of weight 0, add nothing;
equal scores go to the smaller id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linkgraph.llm.common import byte_texts, saved, terms
from linkgraph.operators.numbering import numbered
from linkgraph.session import settings

K = 20
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 19
#: Rows that a task reads and is handed at a time: a row of the documents is a text, one of the index a block.
DOCS_AT_ONCE, BLOCKS_AT_ONCE = 500, 1
QUERY_TERMS = 200_000     # distinct terms of the items that go to the tasks at a time
UNIT = 1_000_000_000

INDEX = pa.schema([
    ("block", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()),
    ("terms", pa.list_(pa.string())), ("held", pa.list_(pa.int32())),   # term, documents of the block that hold it
    ("most", pa.binary()), ("least", pa.binary()),                      # its highest frequency, its shortest document
    ("docs", pa.binary()), ("tfs", pa.binary())])                       # postings, term after term, documents ascending
INDEX_SQL = ("block long, n_docs long, n_terms long, ids binary, sizes binary, terms array<string>, held array<int>, "
             "most binary, least binary, docs binary, tfs binary")


class _Block:
    """Documents gathered for one row of the index."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.ids, self.sizes, self.term, self.tf, self.postings = [], [], [], [], 0

    def add(self, doc_id: int, words: list[bytes]) -> None:
        count, known = Counter(words), self.known
        self.term.append(np.fromiter((known.setdefault(w, len(known)) for w in count), np.int32, len(count)))
        self.tf.append(np.fromiter(count.values(), np.int32, len(count)))
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.postings += len(count)

    def row(self, number: int) -> pa.RecordBatch:
        term, tf, sizes = np.concatenate(self.term), np.concatenate(self.tf), np.array(self.sizes, np.int64)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), [len(t) for t in self.term])
        order = np.argsort(term, kind="stable")
        term, tf, doc = term[order], tf[order], doc[order]
        held = np.bincount(term, minlength=len(self.known))
        first = np.concatenate(([0], np.cumsum(held)[:-1]))
        values = [number, len(sizes), int(sizes.sum()), np.array(self.ids, "<i8").tobytes(), sizes.astype("<i8").tobytes(),
                  [w.decode() for w in self.known], held.astype(np.int32), np.maximum.reduceat(tf, first).astype("<i4").tobytes(),
                  np.minimum.reduceat(sizes[doc], first).astype("<i8").tobytes(), doc.astype("<i4").tobytes(), tf.astype("<i4").tobytes()]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, INDEX)], schema=INDEX)


def _at_once(spark: SparkSession, rows: int):
    """What is written within the block reads and hands over this many rows at a time."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.parquet.columnarReaderBatchSize": rows})


def build_index(docs: DataFrame, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The inverted index of ``docs`` (doc_id, text), written: columns of ``INDEX``."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), byte_texts(part.column(1))):
                if words := terms(text):
                    block.add(doc_id, words)
                if block.postings >= block_postings or len(block.ids) >= block_docs:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.row(number)

    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with _at_once(docs.sparkSession, DOCS_AT_ONCE):
        return saved(rows.mapInArrow(run, INDEX_SQL), "ranking-index")


def query_terms(items: DataFrame) -> DataFrame:
    """(place, item_id, term, times): the distinct terms of every item, written."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i, text in enumerate(byte_texts(part.column(2))):
                count = Counter(terms(text))
                yield pa.record_batch([pa.array([part.column(0)[i].as_py()] * len(count), pa.int64()),
                                       pa.array([part.column(1)[i].as_py()] * len(count), pa.int64()),
                                       pa.array([w.decode() for w in count], pa.string()), pa.array(list(count.values()), pa.int64())],
                                      names=["place", "item_id", "term", "times"])

    rows, _ = numbered(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), "place", kind="ranking-items")
    return saved(rows.select("place", "item_id", "text").mapInArrow(run, "place long, item_id long, term string, times long"), "ranking-terms")


def weighted(index: DataFrame, asked: DataFrame, n_docs: int) -> DataFrame:
    """(place, item_id, term, times, weight): the items' terms that documents hold, written."""
    found = index.select(F.explode(F.arrays_zip("terms", "held")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.held").alias("held"))
    held = found.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("held").alias("df"))
    # A word of many items has one row here, so its items' rows may all meet in one task: they are short.
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    with _at_once(index.sparkSession, BLOCKS_AT_ONCE):
        return saved(asked.join(held, "term").select("place", "item_id", "term", "times", weight.alias("weight")).where("weight > 0"),
                     "ranking-weights")


class Query:
    """An item's terms, rarest first, and its best documents so far."""

    def __init__(self, place: int, item_id: int | None, numbers: np.ndarray, weights: np.ndarray, times: np.ndarray):
        order = np.lexsort((numbers, -weights))    # a rarer term weighs more
        self.place, self.item_id, self.numbers, self.weights = place, item_id, numbers[order], (weights * times)[order]


def length_factor(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 25 + 25 * size * documents / terms, rounded down, per document."""
    if len(sizes) and 25 * int(sizes.max()) * n_docs >= 1 << 63:
        sizes = sizes.astype(object)
    return (75 + (25 * n_docs * sizes) // n_terms).astype(np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (UNIT * tf) // (1000 * tf + 12 * m)


class Scanner:
    """One block of the index, against one query after another."""

    def __init__(self, row: dict, vocabulary: pa.Array, n_docs: int, n_terms: int, k: int):
        self.k = k
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.m = length_factor(np.frombuffer(row["sizes"], "<i8"), n_docs, n_terms)
        self.docs, self.tfs = np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["tfs"], "<i4")
        self.at = np.concatenate(([0], np.cumsum(row["held"].to_numpy(zero_copy_only=False), dtype=np.int64)))
        #: The block's number of each term of the queries, -1 if it holds none.
        self.number = pc.fill_null(pc.index_in(vocabulary, value_set=row["terms"]), -1).to_numpy(zero_copy_only=False)
        most = np.frombuffer(row["most"], "<i4").astype(np.int64)
        self.bound = impact(most, length_factor(np.frombuffer(row["least"], "<i8"), n_docs, n_terms))

    def top(self, query: Query, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of documents scoring above 0; none is missing that is
        among the block's ``k`` best and scores ``floor`` or more."""
        number = self.number[query.numbers]
        here = number >= 0
        number, weight = number[here], query.weights[here]
        left = np.concatenate((np.cumsum((weight * self.bound[number])[::-1])[::-1], [0]))
        score = np.zeros(len(self.ids), np.int64)
        made, alive = True, np.empty(0, np.int64)
        for i, (t, w) in enumerate(zip(number.tolist(), weight.tolist())):
            a, b = self.at[t], self.at[t + 1]
            if made and left[i] < floor:
                made, alive = False, np.flatnonzero(score)
            if made:
                docs = self.docs[a:b]
                score[docs] += w * impact(self.tfs[a:b].astype(np.int64), self.m[docs])
                partial = score[score > 0]
                if len(partial) >= self.k:
                    floor = max(floor, int(np.partition(partial, len(partial) - self.k)[len(partial) - self.k]))
            else:
                spot = a + np.searchsorted(self.docs[a:b], alive)
                hit = spot < b
                hit[hit] = self.docs[spot[hit]] == alive[hit]
                docs, spot = alive[hit], spot[hit]
                score[docs] += w * impact(self.tfs[spot].astype(np.int64), self.m[docs])
        found = np.flatnonzero(score >= max(floor, 1))
        return self.ids[found], score[found]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _matches(index: DataFrame, queries: list[Query], vocabulary: list[str], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(place, item_id, doc_id, score): per task and query its ``k`` best documents."""
    schema = pa.schema([("place", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    shared = index.sparkSession.sparkContext.broadcast((queries, vocabulary))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, words = shared.value
        words = pa.array(words, pa.string())
        tops = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(asked)
        for part in parts:
            for i in range(part.num_rows):
                row = {name: part.column(name)[i] for name in part.schema.names}
                row = {name: v.values if isinstance(v, pa.ListScalar) else v.as_py() for name, v in row.items()}
                block = Scanner(row, words, n_docs, n_terms, k)
                for j, query in enumerate(asked):
                    ids, scores = tops[j]
                    more, found = block.top(query, int(scores[-1]) if len(scores) == k else 1)
                    tops[j] = best(np.concatenate((ids, more)), np.concatenate((scores, found)), k)
        for query, (ids, scores) in zip(asked, tops):
            if len(ids):
                yield pa.record_batch([pa.array([query.place] * len(ids), pa.int64()), pa.array([query.item_id] * len(ids), pa.int64()),
                                       pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], schema=schema)

    return index.select("ids", "sizes", "terms", "held", "most", "least", "docs", "tfs").mapInArrow(
        run, "place long, item_id long, doc_id long, score long")


def _query_blocks(terms_of: DataFrame, limit: int) -> Iterator[tuple[list[Query], list[str]]]:
    """Queries, and the terms that they number, in blocks of about ``limit`` terms."""
    queries, words, place = [], {}, None
    held: list = []

    def close() -> None:
        if held:
            numbers = np.array([words.setdefault(r["term"], len(words)) for r in held], np.int64)
            weights, times = (np.array([r[c] for r in held], np.int64) for c in ("weight", "times"))
            queries.append(Query(place, held[0]["item_id"], numbers, weights, times))

    for r in terms_of.orderBy("place").toLocalIterator():
        if r["place"] != place:
            close()
            held, place = [], r["place"]
            if len(words) >= limit:
                yield queries, list(words)
                queries, words = [], {}
        held.append(r)
    close()
    if queries:
        yield queries, list(words)


def search(index: DataFrame, items: DataFrame, k: int = K, query_limit: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents."""
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    asked = weighted(index, query_terms(items), n_docs)
    found = None
    for queries, vocabulary in _query_blocks(asked, query_limit):
        with _at_once(index.sparkSession, BLOCKS_AT_ONCE):
            some = saved(_matches(index, queries, vocabulary, n_docs, n_terms, k), "ranking-found")
        found = some if found is None else found.unionByName(some)
    if found is None:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the documents ranked for each item."""
    return search(build_index(docs), items, k)
