"""SimHash near-duplicates by covering locality-sensitive hashing.

Every document gets a 64-bit SimHash of its word shingles. Fingerprints that
differ in at most ``radius`` bits link; a document's component is the smallest
``doc_id`` that links reach from it.

Method. Bit i of a fingerprint carries a code c(i) in GF(2)^(radius+1), not
zero. For every non-zero v of that space, table v keeps the bits with
<c(i), v> = 1. Codes of at most ``radius`` differing bits span at most
``radius`` dimensions, so some v is orthogonal to all of them, and the pair
agrees on every bit which table v keeps: it always collides in some table.

Scale. Copies share a fingerprint and are merged (smallest ``doc_id``, partial
aggregation) before anything else. Tables hold distinct fingerprints only, 7
rows each for radius 2. A bucket with more than ``bucket_rows`` fingerprints is
split by the same construction over the bits its table does not keep, again
and again, so no task ever holds a large bucket and no pair is lost. A bucket
yields a spanning forest of its links, never all pairs.

Cases: null text and texts without a word have fingerprint 0 and link like any
other; a text shorter than the shingle is one shingle; repeated rows each keep
their row; a null ``doc_id`` never names a component unless all its members
are null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from linkgraph.llm.common import byte_texts, saved
from linkgraph.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64
BUCKET_ROWS = 2000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash: bit b is 1 if set in more than half of the shingles' hashes."""
    words = text.lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[shingle - 1:].tolist() if len(words) >= shingle else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last)], dtype="<u8")
    # One block of shingles at a time, so that a long text needs little memory.
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *carried: Column) -> DataFrame:
    """(doc_id, th, fp) per row of ``docs``: ``th`` is xxhash64 of the text, fp
    holds the 64 bits as a long; then ``row``, if a column is carried."""
    names = ["doc_id", "th", "fp", *("row" for _ in carried)]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = np.array([fingerprint(t, shingle) for t in byte_texts(part.column(2))], dtype=np.uint64)
            yield pa.record_batch([part.column(0), part.column(1), pa.array(fps.view(np.int64)), *part.columns[3:]], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text", *carried).mapInArrow(
        run, ", ".join(f"{n} long" for n in names))


def masks(kept_out: int, radius: int = RADIUS) -> list[int]:
    """The covering masks over the bits of ``kept_out``, one per table."""
    tables = (1 << (radius + 1)) - 1
    bits = [b for b in range(BITS) if kept_out >> b & 1]
    # Codes run through all non-zero vectors in turn, so every mask keeps
    # about (2**radius)/(2**(radius+1)-1) of the bits.
    return [sum(1 << b for i, b in enumerate(bits) if bin((i % tables + 1) & v).count("1") % 2)
            for v in range(1, tables + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _buckets(rows: DataFrame, radius: int) -> DataFrame:
    """A row per fingerprint and table: (bucket, free, fp).

    ``rows`` has fp, the ``bucket`` it comes from and its ``free`` bits, those
    that no mask on its path has fixed. A bucket is the text of the masked bits
    on its path of tables, exact, so that unlike buckets never meet.
    """
    # As many values as paths of tables: a table per path and depth, whatever the input.
    paths = [r[0] % (1 << BITS) for r in rows.select("free").distinct().collect()]
    tables = [(_signed(free), v, _signed(mask), _signed(free & ~mask))
              for free in paths for v, mask in enumerate(masks(free, radius))]
    tables = rows.sparkSession.createDataFrame(tables, "free long, v int, mask long, rest long")
    key = F.concat_ws(",", "bucket", F.concat("v", F.lit(":"), F.hex(F.col("fp").bitwiseAND(F.col("mask")))))
    return rows.join(F.broadcast(tables), "free").select(key.alias("bucket"), F.col("rest").alias("free"), "fp")


def bucket_links(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints."""
    label, links = np.arange(len(fps)), []
    for i in range(len(fps) - 1):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= radius) + i + 1
        other, at = np.unique(label[near], return_index=True)
        for old, j in zip(other.tolist(), near[at].tolist()):
            if old != label[i]:
                links.append((i, j))
                label[label == old] = label[i]
    return links


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(src, dst) links between distinct fingerprints (column ``fp``).

    Their closure equals that of all pairs within ``radius`` bits.
    """
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            src, dst = [], []
            for group in part.column(0):
                fps = np.array(group.as_py(), dtype=np.int64)
                for i, j in bucket_links(fps, radius):
                    src.append(fps[i])
                    dst.append(fps[j])
            yield pa.record_batch([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], schema=schema)

    whole = distinct.select("fp", F.lit("").alias("bucket"), F.lit(-1).cast("long").alias("free"))
    found, rows = [], saved(_buckets(whole, radius), "simhash-buckets")
    while True:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        hot = saved(sizes.where(F.col("n") > bucket_rows).select("bucket"), "simhash-hot")
        some_hot = not hot.isEmpty()
        cool = rows if not some_hot else rows.join(hot, "bucket", "left_anti")
        groups = cool.groupBy("bucket").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        found.append(saved(groups.select("fps").mapInArrow(run, "src long, dst long"), "simhash-links"))
        if not some_hot:
            break
        # Fingerprints of one bucket differ in their free bits only.
        rows = saved(_buckets(rows.join(hot, "bucket", "left_semi"), radius), "simhash-buckets")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _rooted(classes: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """``classes``, a row per distinct ``fp``, with their component's ``root`` fingerprint."""
    links = fingerprint_links(classes.select("fp"), radius, bucket_rows)
    label = components(links)  # (id, root) for linked fingerprints only
    return classes.join(label.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, th, fp, component_id) per row of ``docs``."""
    rows = saved(fingerprints(docs, shingle), "simhash-fps")
    classes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    named = _rooted(classes, radius, bucket_rows)
    by_root = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = named.join(by_root, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "th", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` per component; the rest go.

    The row with the smallest ``doc_id`` stays, a null one only where no member
    has an id; among equal ids the smallest text hash, then the first row. Rows
    are numbered in a written copy of ``docs``, so that the one that stays is
    the same whatever is computed again.
    """
    number = "__row"
    while number.lower() in (c.lower() for c in docs.columns):
        number += "_"
    rows = saved(docs.withColumn(number, F.monotonically_increasing_id()), "simhash-rows")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "row")
    classes = saved(fingerprints(rows, shingle, F.col(number)).groupBy("fp").agg(F.min(place).alias("first")), "simhash-classes")
    stay = _rooted(classes, radius, BUCKET_ROWS).groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(stay.select(F.col("first.row").alias(number)), number, "left_semi").drop(number)
