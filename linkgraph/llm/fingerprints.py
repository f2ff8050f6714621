"""Document fingerprints: bottom-k sketches of shingle hashes, with DataFrame functions only.

A text's shingles are its runs of five words; a shingle's hash is the first 64
bits of its MD5, as 16 hex digits, so that text order is numeric order. The
fingerprint is the ``k`` smallest distinct hashes, ascending. Fingerprints of
parts merge: the ``k`` smallest of their union are the fingerprint of the whole.
Long texts are sketched that way, ``PART`` shingles at a time, so that no more
hashes than one part's are held next to the text's words.

From fingerprints alone:

* resemblance: of the ``k`` smallest hashes of the union, the share in both;
* containment of A in B: of those of them that are A's, the share that is B's;
* distinct shingles: the count itself below ``k``, else (k - 1) over the largest
  hash as a fraction of all hashes.

With fewer than ``k`` shingles in the union all three are exact.

Each document is also compared with the next one by id. Documents are dealt by
ranges of (id, hash of the text) whose ends come from a sample (they decide the
layout, never the result), the first row of each range is sent to the range
before it too, and the next row is found inside a range: texts move once, and
no table-wide window is needed.

Cases: a null text counts as empty; an empty or blank text has no shingles, its
fingerprint is empty, and two of them resemble each other by 1, one of them and
another text by 0; a text of fewer than five words is one shingle; null ids come
last; rows with equal id are ordered by a hash of the text, and equal rows are
each other's next; the only row's next is itself; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkgraph.llm.common import SPACES, WORD_GAP

K = 128
WIDTH = 5
PART = 1024
#: Rows that a range of ids holds, about, and the most ranges (their ends are a literal of the plan).
RANGE_ROWS, MAX_RANGES, SAMPLES = 1024, 1 << 14, 20
DIGITS = 16


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _lowest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The ``k`` smallest distinct shingle hashes of a text, ascending."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))

    def sketch(w: Column) -> Column:
        last = F.greatest(F.size(w) - width, F.lit(0))

        def add(found: Column, start: Column) -> Column:
            part = F.sequence(start, F.least(start + PART - 1, last))
            hashes = F.transform(part, lambda i: F.substring(F.md5(F.array_join(F.slice(w, i + 1, width), " ").cast("binary")), 1, DIGITS))
            # Nothing above the k-th smallest so far can be among the k smallest.
            low = F.filter(hashes, lambda h: F.coalesce(h < F.get(found, F.lit(k - 1)), F.lit(True)))
            return _lowest(F.concat(found, low), k)

        none = F.array().cast("array<string>")
        return F.when(F.size(w) == 0, none).otherwise(F.aggregate(F.sequence(F.lit(0), last, F.lit(PART)), none, add))

    return _let(words, sketch)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of two parts together."""
    return _lowest(F.concat(a, b), k)


def merged(rows: DataFrame, by: str, sketch: str, k: int = K) -> DataFrame:
    """(``by``, ``sketch``): the fingerprints of all rows of a group merged.

    Hashes are made distinct before groups meet, and every task sends at most
    ``k`` of them for a group, however many rows it has.
    """
    hashes = rows.select(by, F.explode(sketch).alias("__h")).distinct()
    order = Window.partitionBy(by).orderBy("__h")
    low = hashes.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k)
    found = low.groupBy(by).agg(F.sort_array(F.collect_list("__h")).alias(sketch))
    groups = rows.select(by).distinct().withColumnRenamed(by, "__by")
    none = F.array().cast("array<string>")
    return groups.join(found, F.col("__by").eqNullSafe(F.col(by)), "left").select(
        F.col("__by").alias(by), F.coalesce(sketch, none).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the union's shingles that both texts have."""
    def share(u: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(u, a), b))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u))

    return _let(merge(a, b, k), share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has; 1 if it has none."""
    return _let(F.array_intersect(merge(a, b, k), a), lambda own: F.when(F.size(own) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(own, b)) / F.size(own)))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    largest = F.conv(F.get(sketch, F.lit(k - 1)), 16, 10).cast("decimal(20,0)").cast("double")
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit((k - 1) * 2.0 ** 64) / largest)


def _key() -> Column:
    """What documents are ordered by: nulls last, equal ids by their texts."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text").alias("h"))


def _range_of(key: Column, ends: list) -> Column:
    """How many of the ascending ``ends`` are not above ``key``: a binary search."""
    if not ends:
        return F.lit(0)
    literal = F.from_json(F.lit(json.dumps([e.asDict() for e in ends])), "array<struct<none:boolean,id:bigint,h:bigint>>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(ends).bit_length()))])
    return _let(key, lambda it: F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(ends)) & (F.get(literal, at + step - 1) <= it), at + step).otherwise(at)))


def with_next(docs: DataFrame, sketch: Callable[[Column], Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch) of every row of ``docs``, by ascending id, round about."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    ranges = max(1, min(MAX_RANGES, n // range_rows))
    sample = rows.sample(min(1.0, SAMPLES * ranges / n), 1).select(_key().alias("k")).orderBy("k").collect() if ranges > 1 else []
    ends = sorted({r["k"] for r in sample[SAMPLES::SAMPLES]})
    rows = rows.withColumn("r", _range_of(_key(), ends)).withColumn("extra", F.lit(False))

    # The first row of every range, bounded by the number of ranges, is also the last of the range before it.
    firsts = sorted((tuple(r["k"]), r["r"]) for r in rows.groupBy("r").agg(F.min(_key()).alias("k")).collect())
    before = [(*key, firsts[i - 1][1]) for i, (key, _) in enumerate(firsts)]
    known = docs.sparkSession.createDataFrame(before, "none boolean, id long, h long, to int")
    extra = (rows.withColumn("k", _key()).join(F.broadcast(known), [F.col("k.none") == F.col("none"), F.col("k.id") == F.col("id"), F.col("k.h") == F.col("h")])
             .groupBy("to").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")))
    extra = extra.select("doc_id", "text", F.col("to").alias("r"), F.lit(True).alias("extra"))

    dealt = rows.unionByName(extra).repartition("r").withColumns({"sketch": sketch(F.col("text")), "k": _key()})
    order = Window.partitionBy("r").orderBy("extra", "k")
    following = dealt.withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)})
    return following.where(~F.col("extra")).select("doc_id", "text", "sketch", "next_text", "next_sketch")


def with_edits(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """(doc_id, text, sketch, next_sketch, edited, edited_sketch): every text, and the
    text with its last quarter replaced by as much of the start of the next one."""
    rows = with_next(docs, lambda text: fingerprint(text, k, width))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    return rows.withColumn("edited", edited).withColumn("edited_sketch", fingerprint(F.col("edited"), k, width)).drop("next_text")
