"""Exact top-k inner products: vectors by descending length, pruned by bounds.

Vectors are quantised to whole numbers and rotated by the singular vectors of
all of them, so that the first dimensions carry most of every product. The
candidates are range-sorted by descending length and packed into stripes; the
queries into blocks. A block meets a stripe once. There, candidates are taken
in order of length, a few thousand at a time:

* if |q| |c| for the longest candidate left is below the query's k-th best
  score so far, the query is done with the stripe;
* partial products over the first dimensions, plus |q'| |c'| for what is left
  of both (Cauchy-Schwarz), rule out most pairs;
* the rest get their full product, and pairs that could reach the k-th score
  are scored in whole numbers.

The k-th best score starts from the ``seed`` longest vectors, whose number is
fixed, so every block has a threshold before it meets any stripe. Bounds are
taken with a margin for rounding; scores themselves are whole numbers, so the
result is exact. Sums of products may wrap around 64 bits on the way: if the
score fits 64 bits, what comes out is the score.

Scale. A block goes only to the stripes whose longest vector could still reach
the threshold of one of its queries: stripes are ranges of the length, so these
are the first few, known before anything moves. Work is (queries x candidates)
at worst, in blocks spread over all tasks; a task holds a stripe (8 MB at 64
dimensions) and a block, and ``PAIRED`` pairs of them on their way to it, where
components take the fewest bytes that hold them all. What reaches the driver:
counts, the d x d product matrix, the length of each stripe, the seed vectors,
and the last stripe of each class of lengths (sixteen classes to a doubling).
The seed vectors are cut from the first stripes, so no task sends its own.

Cases: vectors that are null or hold null or non-finite components, and rows
with a null id, take no part; shorter vectors count as padded with zeros;
finite components of any size count as they are, but one whose quantised value
does not fit 64 bits, and a score to be returned that does not, end the job with
an error that names the row; candidates that share the query's id are its own; repeated rows are candidates (and queries) each;
ties go to the smaller id; no rows or no queries give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from linkgraph.llm.common import saved
from linkgraph.session import settings

K = 20
SCALE = 64
SEED_VECTORS = 2048
STRIPE, BLOCK, STEP = 16384, 512, 2048
PAIRS = 1 << 15
#: Pairs of a block and a stripe that a task is handed at a time.
PAIRED = 4
#: What 64-bit values hold, less a margin for the rounding of the estimate that is compared with it.
MOST = 2.0 ** 63 * (1 - 1e-6)
#: Classes of length to a doubling.
CLASSES = 16
#: Share of the squared length that the first dimensions of the rotation carry.
ENERGY = 0.7


def quantised(rows: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<long>, length) of the rows that take part."""
    schema = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.int64())), ("length", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            vectors = part.column(1)
            ends = np.asarray(vectors.offsets).astype(np.int64)
            x = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
            fine = np.isfinite(x)
            bad = np.concatenate(([0], np.cumsum(~fine)))
            whole = np.floor(np.where(fine, x, 0.0) * scale)
            taken = np.flatnonzero(bad[ends[1:]] == bad[ends[:-1]])
            starts, sizes = ends[taken], ends[taken + 1] - ends[taken]
            at = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, sizes)] or [np.empty(0, np.int64)])
            whole, owner = whole[at], np.repeat(np.arange(len(taken)), sizes)
            huge = np.flatnonzero(np.abs(whole) >= MOST)
            if len(huge):
                raise OverflowError(f"{id_col} {part.column(0)[taken[owner[huge[0]]]]}: a component times {scale} does not fit 64 bits")
            length = np.sqrt(np.bincount(owner, whole * whole, minlength=len(taken)))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(whole.astype(np.int64)))
            yield pa.record_batch([part.column(0).take(pa.array(taken)), lists, pa.array(length)], schema=schema)

    given = rows.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
    return given.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(
        run, "id long, v array<long>, length double")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """A list column as rows of ``d`` whole numbers, short lists padded."""
    out = np.zeros((len(column), d), np.int64)
    ends = np.asarray(column.offsets)
    flat = np.asarray(column.values)
    if len(column) and np.all(np.diff(ends) == d):
        return flat[ends[0]:ends[-1]].reshape(-1, d).astype(np.int64)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        out[i, : b - a] = flat[a:b]
    return out


def rotation(vectors: DataFrame, d: int) -> tuple[np.ndarray, int]:
    """Right singular vectors (d x d), and how many of them carry ENERGY."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("x", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d))
        for part in parts:
            m = _matrix(part.column(0), d).astype(float)
            gram += m.T @ m
        i, j = np.indices((d, d), dtype=np.int32)
        yield pa.record_batch([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(gram.ravel())], schema=schema)

    gram = np.zeros((d, d))
    for r in vectors.select("v").mapInArrow(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        gram[r["i"], r["j"]] = r["x"]
    values, axes = np.linalg.eigh((gram + gram.T) / 2)
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(axes), int(min(d, np.searchsorted(share, ENERGY) + 1))


def packed(vectors: DataFrame, rows: int, parts: int, d: int) -> DataFrame:
    """Vectors by descending length, up to ``rows`` of them to a row.

    (part, pack, ids binary, data binary, longest): parts are ranges of the length.
    """
    schema = pa.schema([("part", pa.int32()), ("pack", pa.int64()), ("ids", pa.binary()), ("data", pa.binary()), ("longest", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, ids, data = TaskContext.get().partitionId(), 0, [], []

        def pack(count: int) -> pa.RecordBatch:
            nonlocal n, ids, data
            all_ids, all_data = np.concatenate(ids), np.concatenate(data)
            ids, data = [all_ids[count:]], [all_data[count:]]
            n += 1
            longest = np.sqrt((all_data[0].astype(float) ** 2).sum())
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([(part << 32) + n], pa.int64()), pa.array([all_ids[:count].tobytes()], pa.binary()),
                                    pa.array([_bytes(all_data[:count])], pa.binary()), pa.array([longest])], schema=schema)

        for b in batches:
            ids.append(b.column(0).to_numpy())
            data.append(_matrix(b.column(1), d))
            while sum(map(len, ids)) >= rows:
                yield pack(rows)
        if sum(map(len, ids)):
            yield pack(rows)

    order = [F.col("length").desc(), F.col("id"), F.xxhash64("v")]
    spread = vectors.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return spread.select("id", "v").mapInArrow(run, "part int, pack long, ids binary, data binary, longest double")


def longest_of(stripes: DataFrame, seed: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the ``seed`` longest, cut from the first stripes where they lie."""
    sizes = stripes.select("pack", (F.octet_length("ids") / 8).cast("long").alias("n")).orderBy("pack").limit(seed).collect()
    left, taken = seed, {}
    for pack, n in sizes:
        if left <= 0:
            break
        taken[pack], left = min(n, left), left - n

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                pack, ids, data = (part.column(c)[i].as_py() for c in range(3))
                end = 8 * taken[pack]
                yield pa.record_batch([pa.array([pack], pa.int64()), pa.array([ids[:end]], pa.binary()),
                                       pa.array([data[:len(data) * end // len(ids)]], pa.binary())], names=["pack", "ids", "data"])

    first = stripes.where(F.col("pack") <= max(taken, default=-1)).select("pack", "ids", "data").mapInArrow(run, "pack long, ids binary, data binary").collect()
    cut = [_unpacked(r["ids"], r["data"], d) for r in sorted(first, key=lambda r: r["pack"])]
    return np.concatenate([np.empty(0, np.int64), *(x for x, _ in cut)]), np.concatenate([np.empty((0, d), np.int64), *(v for _, v in cut)])


def best(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of each owner's k best entries: highest score, then smallest id."""
    order = np.lexsort((ids, -score, owner))
    own = owner[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, int)
    place = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return order[place < k]


def kth(owner: np.ndarray, score: np.ndarray, n: int, k: int) -> np.ndarray:
    """Each owner's lowest score if it has ``k`` entries, else the lowest number there is."""
    worst = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(worst, owner, score)
    return np.where(np.bincount(owner, minlength=n) >= k, worst, np.iinfo(np.int64).min)


class Matcher:
    """A block of queries against candidates by descending length."""

    def __init__(self, axes: np.ndarray, head: int, k: int):
        self.axes, self.head, self.k = axes, head, k

    def rotated(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rotated vectors, their lengths, and the lengths past the head."""
        r = v.astype(float) @ self.axes
        return r, np.sqrt((v.astype(float) ** 2).sum(axis=1)), np.sqrt((r[:, self.head:] ** 2).sum(axis=1))

    def match(self, q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, c_ids: np.ndarray, c: np.ndarray) -> tuple:
        """(query index, candidate id, score): at most k each, none missing that scores ``floor`` or more."""
        k, h, floor = self.k, self.head, floor.copy()    # whole numbers, as the scores are
        qr, ql, qt = self.rotated(q)
        own, ids, score = np.empty(0, int), np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(c), STEP):
            part = c[at:at + STEP]
            cr, cl, ct = self.rotated(part)
            slack = 1e-9 * ql * (cl.max() if len(cl) else 0) + 1e-6  # rounding of any product below
            live = np.flatnonzero(ql * cl.max() + slack >= floor)
            if not len(live):
                break  # all later candidates are shorter
            head = qr[live, :h] @ cr[:, :h].T
            need = (floor.astype(float) - slack)[live, None]
            near = head + np.outer(qt[live], ct) >= need
            some_q, some_c = near.any(axis=1), near.any(axis=0)
            if not some_q.any():
                continue
            rows, cols = live[some_q], np.flatnonzero(some_c)
            full = head[np.ix_(some_q, some_c)] + qr[rows, h:] @ cr[cols, h:].T
            i, j = np.nonzero(full >= need[some_q])
            large = np.flatnonzero((np.abs(full[i, j]) >= MOST) & (c_ids[at + cols[j]] != q_ids[rows[i]]))
            if len(large):
                raise OverflowError(f"the score of {c_ids[at + cols[j[large[0]]]]} for {q_ids[rows[i[large[0]]]]} does not fit 64 bits")
            i, j = rows[i], cols[j]
            # Pairs in parts: what is gathered for their scores stays small.
            exact = np.concatenate([np.einsum("ij,ij->i", q[i[a:a + PAIRS]], part[j[a:a + PAIRS]]) for a in range(0, len(i), PAIRS)]
                                   or [np.empty(0, np.int64)])
            right = (exact >= floor[i]) & (c_ids[at + j] != q_ids[i])
            own, ids = np.concatenate((own, i[right])), np.concatenate((ids, c_ids[at + j[right]]))
            score = np.concatenate((score, exact[right]))
            top = best(own, score, ids, k)
            own, ids, score = own[top], ids[top], score[top]
            floor = np.maximum(floor, kth(own, score, len(q), k))
        return own, ids, score


def class_of(length: float) -> int:
    """Class of a length: rising with it, ``CLASSES`` to a doubling; 0 below 1."""
    return 1 + int(CLASSES * math.log2(length)) if length >= 1 else 0


def last_stripes(stripes: DataFrame) -> list[int]:
    """For every class, the last stripe whose longest vector is of it or a higher one; -1 if none is."""
    cls = F.when(F.col("longest") >= 1, 1 + F.floor(CLASSES * F.log2("longest"))).otherwise(0).cast("int")
    last = dict(tuple(r) for r in stripes.groupBy(cls).agg(F.max("part")).collect())
    out, seen = [], -1
    for c in range(max(last, default=0), -1, -1):
        seen = max(seen, last.get(c, -1))
        out.append(seen)
    return out[::-1]


def cells(queries: DataFrame, stripes: DataFrame, matcher: Matcher, longest: tuple[np.ndarray, np.ndarray], d: int) -> DataFrame:
    """Blocks of queries with thresholds from the longest vectors, a row for every
    stripe that could hold a better one: (block, q_ids, q_data, floor, part)."""
    last = last_stripes(stripes)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                ids, q = _unpacked(part.column(2)[i].as_py(), part.column(3)[i].as_py(), d)
                own, _, score = matcher.match(ids, q, np.full(len(q), np.iinfo(np.int64).min), *longest)
                floor = kth(own, score, len(q), matcher.k)
                # The shortest candidate that could reach the threshold of some query, less the margin of the bounds.
                length = np.sqrt((q.astype(float) ** 2).sum(axis=1))
                reach = np.where((floor <= 0) | (length == 0), 0.0, (floor.astype(float) - 1e-5) / np.maximum(length, 1) * (1 - 1e-8)).min()
                low = max(class_of(reach) - 1, 0)
                yield pa.record_batch([part.column(1).slice(i, 1), part.column(2).slice(i, 1), part.column(3).slice(i, 1),
                                       pa.array([floor.astype("<i8").tobytes()], pa.binary()),
                                       pa.array([last[low] if low < len(last) else -1], pa.int32())],
                                      names=["block", "q_ids", "q_data", "floor", "last"])

    blocks = saved(queries.mapInArrow(run, "block long, q_ids binary, q_data binary, floor binary, last int"), "topk-blocks")
    return blocks.where("last >= 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")


def top_k(rows: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
          seed: int = SEED_VECTORS, stripe: int = STRIPE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all other rows.

    ``is_query`` is a condition on the id, as the column ``id``.
    """
    vectors = saved(quantised(rows, id_col, vec_col, scale), "topk-vectors")
    n, d, asked = vectors.agg(F.count("*"), F.max(F.size("v")), F.count(F.when(is_query, 1))).first()
    d = max(d or 0, 1)
    matcher = Matcher(*rotation(vectors, d), k)
    n_stripes = max(1, -(-n // stripe))
    stripes = saved(packed(vectors, stripe, n_stripes, d), "topk-stripes")
    queries = packed(vectors.where(is_query), block, max(1, -(-asked // block)), d)
    some = cells(queries, stripes, matcher, longest_of(stripes, seed, d), d)
    schema = pa.schema([("q_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                q_ids, q = _unpacked(part.column(1)[i].as_py(), part.column(2)[i].as_py(), d)
                c_ids, c = _unpacked(part.column(4)[i].as_py(), part.column(5)[i].as_py(), d)
                floor = np.frombuffer(part.column(3)[i].as_py(), "<i8")
                own, ids, score = matcher.match(q_ids, q, floor, c_ids, c)
                yield pa.record_batch([pa.array(own + part.column(0)[i].as_py() * block), pa.array(q_ids[own]), pa.array(ids), pa.array(score)], schema=schema)

    # Estimated by its blocks, the side of the cells might be broadcast with a block for each stripe.
    pairs = some.hint("merge").join(stripes.select("part", "ids", "data"), "part").select("block", "q_ids", "q_data", "floor", "ids", "data")
    # Much work for few bytes: a partition for each stripe, whatever its size.
    with settings(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": PAIRED, "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                      "spark.sql.shuffle.partitions": max(n_stripes, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))}):
        found = saved(pairs.mapInArrow(run, "q_row long, query_id long, vec_id long, score long"), "topk-found")
    order = Window.partitionBy("q_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _bytes(whole: np.ndarray) -> bytes:
    """Rows of whole numbers in the fewest bytes a component that hold them all."""
    least, most = whole.min(), whole.max()
    return whole.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max)).tobytes()


def _unpacked(ids: bytes, data: bytes, d: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(data, f"<i{len(data) // (len(ids) * d)}").reshape(-1, d).astype(np.int64)
