"""Target-distribution importance resampling over hashed word runs.

Texts become bags of hashed features: runs of 1 to ``order`` words, each in the
bucket that its CRC-32 gives. Corpus and target texts are counted per bucket;
a bucket's gain is the logarithm of how much likelier the target makes it, in
whole thousandths, and a document's weight is the sum of its features' gains,
read from an array of all gains. With a Gumbel term made from the document's id
the highest scores are a draw without replacement, by weight.

The draw takes the n highest scores. A quantile sketch of the scores brackets
the n-th; exact counts of the scores outside tell whether the bracket holds it,
and widen it if not; only the bracket's rows are sorted to find the cutoff. The
drawn rows are then ranked by a range sort.

Scale. Texts are read twice and never moved; bucket counts are summed in every
task first (a task sends at most ``buckets`` rows). The driver sees bucket
counts (bounded by ``buckets``), a few scalars, and a row per partition. What is
shuffled: drawn rows and the bracket's, four numbers each.

Cases: null and blank texts have no feature (weight 0) and are never drawn;
rows are documents each, repeated or not; a null id hashes as an empty one and
comes last among equal scores; rows that tie in score and id are ordered by
weight, then feature count; an empty target or corpus gives gains by the same
formula; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linkgraph.llm.common import byte_texts, saved, terms
from linkgraph.operators.numbering import numbered

ORDER = 1
BUCKETS = 10_000
MIN_WORDS = 20
SHARE = 10           # per cent of the documents that are long enough
SEED = 2024
ACCURACY = 10_000    # of the quantile sketch: rank error about 1 / ACCURACY
CACHE = 500_000      # words whose bucket a task remembers


class Buckets(dict):
    """Bucket of a feature's bytes; forgets all when it holds ``CACHE``."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature) % self.buckets
        return bucket

    def of(self, words: list[bytes], order: int) -> np.ndarray:
        """Buckets of all runs of 1 to ``order`` words."""
        runs = words if order == 1 else [b" ".join(words[i:i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]
        return np.fromiter(map(self.__getitem__, runs), np.int64, len(runs))


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of ``texts`` (one column of texts)."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = Buckets(buckets), np.zeros(buckets, np.int64)
        for part in parts:
            for text in byte_texts(part.column(0)):
                count += np.bincount(known.of(terms(text), order), minlength=buckets)
        found = np.flatnonzero(count)
        yield pa.record_batch([pa.array(found), pa.array(count[found])], schema=schema)

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-likelihood gain of each bucket under add-one smoothing, in thousandths."""
    buckets = len(corpus)
    s_all, t_all = float(corpus.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(len(gain))
        for part in parts:
            rows = []
            for text in byte_texts(part.column(1)):
                words = terms(text)
                found = known.of(words, order)
                rows.append((len(words), len(found), int(gain[found].sum())))
            columns = zip(*rows) if rows else [[], [], []]
            yield pa.record_batch([part.column(0), *(pa.array(c, pa.int64()) for c in columns)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """A document's Gumbel term in thousandths, from a hash of its id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def bracket(scores: DataFrame, n: int, total: int, accuracy: int = ACCURACY) -> tuple[int | None, int | None, int]:
    """(lowest, highest, scores above highest): scores between them, both
    included, hold the ``n``-th highest of ``total``; None is an open end."""
    width, place = 2.0 / accuracy, 1.0 - n / total
    while True:
        ends = [max(place - width, 0.0), min(place + width, 1.0)]
        low, high = scores.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        low, high = low if ends[0] > 0 else None, high if ends[1] < 1 else None
        above, reach = scores.agg(
            F.count(F.when(F.col("score") > high, 1)) if high is not None else F.lit(0),
            F.count(F.when(F.col("score") >= low, 1)) if low is not None else F.count(F.lit(1))).first()
        if above < n <= reach:
            return low, high, above
        width *= 8


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").asc()]


def _key(score: Column, doc_id: Column, weight: Column, n_features: Column) -> Column:
    """What ``_order`` sorts by, rising, as one value that can be compared."""
    return F.struct((-score).alias("a"), doc_id.isNull().alias("b"), F.coalesce(doc_id, F.lit(0)).cast("long").alias("c"),
                    (-weight).alias("d"), n_features.alias("e"))


def draw(scored: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, accuracy: int = ACCURACY) -> DataFrame:
    """``scored`` (a written table) with ``rank``: 1 … n for the drawn rows, null for others."""
    able = scored.where(F.col("n_words") >= min_words)
    total = able.count()
    n = share * total // 100
    if not n:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    low, high, above = bracket(able.select("score"), n, total, accuracy)
    inside = able
    if low is not None:
        inside = inside.where(F.col("score") >= low)
    if high is not None:
        inside = inside.where(F.col("score") <= high)
    placed, _ = numbered(inside.select("score", "doc_id", "weight", "n_features"), "place", *_order(), kind="resample-bracket")
    last = placed.where(F.col("place") == n - above - 1).first()
    cut = _key(*(F.lit(last[c]).cast("long") for c in ("score", "doc_id", "weight", "n_features")))
    here = _key(*map(F.col, ("score", "doc_id", "weight", "n_features")))
    drawn = (F.col("n_words") >= min_words) & (here <= cut)
    ranked, _ = numbered(scored.where(drawn), "place", *_order(), kind="resample-drawn")
    # Rows that tie with the last one in everything may be one too many.
    rank = F.when(F.col("place") < n, F.col("place") + 1).cast("long")
    return (ranked.select(*scored.columns, rank.alias("rank"))
            .unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, order: int = ORDER, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, seed: int = SEED, accuracy: int = ACCURACY) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``docs``.

    ``target`` holds texts of the wanted distribution in a column ``text``.
    ``share`` per cent of the documents with ``min_words`` words or more are
    drawn; the others' rank is null.
    """
    gain = gains(bucket_counts(docs.select("text"), order, buckets), bucket_counts(target.select("text"), order, buckets))
    scored = weights(docs, gain, order).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return draw(saved(scored, "resample-scores"), share, min_words, accuracy)
