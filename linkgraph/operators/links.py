"""Links inside a task: laid out as target lists, read back, and summed by target.

These functions run under ``mapInArrow`` and hold at most ``LINKS_AT_ONCE`` links
and one more batch. A group that such a cut divides comes out in several rows,
which the join and the sum that follow take as they are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Workers get the functions themselves: they need not have this library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ``dst_vids``: target numbers of 8 bytes each, little-endian, so that a list moves and is kept as one value.
LIST_SCHEMA = "src_vid bigint, bucket bigint, w double, dst_vids binary"
SUM_SCHEMA = "vid bigint, u bigint, f bigint"
# What moves to the vertices: a row per block of neighbouring vertex numbers (and task), with the
# numbers and two sums of those met (``sums``), and for vertices' own rows their columns (``own``).
BLOCK_SCHEMA = "block bigint, sums binary, own binary"
# Links sorted at a time (a task of the round takes about 30 bytes for each).
LINKS_AT_ONCE = 4 << 20
# Rows, and links in lists, of one batch handed on.
ROWS_OUT, LINKS_OUT = 1 << 16, 1 << 20


def _chunks(batches: Iterator[pa.RecordBatch], links) -> Iterator[pa.Table]:
    """Batches put together until they hold ``LINKS_AT_ONCE`` links."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += links(batch)
        if n >= LINKS_AT_ONCE:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new value of the keys begins."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[0] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _sorted_by(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``key`` sorted, with ``row`` (ascending) in the same order. The two are
    sorted as one number where it fits 63 bits, which is many times faster."""
    bits = int(row[-1]).bit_length()
    if int(key.max()).bit_length() + bits > 63:
        order = np.argsort(key, kind="stable")
        return key[order], row[order]
    both = key << bits
    both |= row
    both.sort()
    return both >> bits, both & ((1 << bits) - 1)


def list_rows(starts: np.ndarray, dst: np.ndarray) -> Iterator[tuple[int, int, pa.Array]]:
    """The lists of ``dst`` that begin at ``starts``, a bounded number at a time: from which to which, and their values."""
    ends = np.append(starts[1:], len(dst))
    a = 0
    while a < len(starts):
        b = max(a + 1, min(a + ROWS_OUT, int(np.searchsorted(ends, starts[a] + LINKS_OUT, "right"))))
        first = int(starts[a])
        places = ((np.append(starts[a:b], ends[b - 1]) - first) * 8).astype(np.int32)
        targets = np.ascontiguousarray(dst[first:ends[b - 1]], "<i8")
        yield a, b, pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(places), pa.py_buffer(targets)])
        a = b


def link_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(src_vid, bucket, dst_vid, w)`` to ``LIST_SCHEMA``: the targets that
    a source reaches with one weight from one bucket."""
    for table in _chunks(batches, lambda b: b.num_rows):
        src, order = _sorted_by(_column(table, "src_vid"), np.arange(table.num_rows))
        bucket, w, dst = (_column(table, c)[order] for c in ("bucket", "w", "dst_vid"))
        # Most sources have one bucket and one weight; only links of the others are sorted by them.
        mixed = (src[1:] == src[:-1]) & ((bucket[1:] != bucket[:-1]) | (w[1:] != w[:-1]))
        if mixed.any():
            firsts = _starts(src)
            several = np.add.reduceat(np.append(False, mixed).astype(np.int64), firsts) > 0
            at = np.flatnonzero(np.repeat(several, np.diff(np.append(firsts, len(src)))))
            by = at[np.lexsort((w[at], bucket[at], src[at]))]
            bucket[at], w[at], dst[at] = bucket[by], w[by], dst[by]
        starts = _starts(src, bucket, w)
        for a, b, lists in list_rows(starts, dst):
            at = starts[a:b]
            yield pa.RecordBatch.from_arrays([pa.array(src[at]), pa.array(bucket[at]), pa.array(w[at]), lists], ["src_vid", "bucket", "w", "dst_vids"])


def _targets(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All targets of the lists, and for each the place of its list."""
    lengths = pc.binary_length(lists).to_numpy(zero_copy_only=False) // 8
    first = np.frombuffer(lists.buffers()[1], np.int32, 1, 4 * lists.offset)[0]
    return np.frombuffer(lists.buffers()[2], "<i8", int(lengths.sum()), int(first)), np.repeat(np.arange(len(lists)), lengths)


def _lists(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.cast(pa.binary())


def links_of_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(src, c, dst_vids)`` to ``(src, c, dst_vid)``, one per link."""
    for batch in batches:
        for a in range(0, batch.num_rows, 1 << 10):
            some = batch.slice(a, 1 << 10)
            target, row = _targets(_lists(some.column("dst_vids")))
            for x in range(0, len(target), ROWS_OUT):
                at = pa.array(row[x:x + ROWS_OUT])
                yield pa.RecordBatch.from_arrays([some.column("src").take(at), some.column("c").take(at), pa.array(target[x:x + ROWS_OUT])], ["src", "c", "dst_vid"])


def sums_by_target(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(dst_vids, u, f)`` to ``SUM_SCHEMA``: ``u`` and ``f``, whole
    numbers, summed over the links to each target."""
    for table in _chunks(batches, lambda b: pc.sum(pc.binary_length(b.column("dst_vids"))).as_py() // 8 if b.num_rows else 0):
        target, row = _sorted_by(*_targets(_lists(table["dst_vids"])))
        starts = _starts(target)
        sums = [target[starts], *(np.add.reduceat(_column(table, c)[row], starts) for c in ("u", "f"))]
        for a in range(0, len(starts), ROWS_OUT):
            yield pa.RecordBatch.from_arrays([pa.array(c[a:a + ROWS_OUT]) for c in sums], ["vid", "u", "f"])


def _pieces(places: np.ndarray, *columns: np.ndarray) -> pa.Array:
    """One value for each of ``places[i]:places[i + 1]``: that piece of every column, one after another."""
    raw = [np.ascontiguousarray(c).view(np.uint8) for c in columns]
    return pa.array([b"".join(r[8 * a:8 * b] for r in raw) for a, b in zip(places[:-1], places[1:])], pa.binary())


def _blocks(size: int, vid: np.ndarray, u: np.ndarray, f: np.ndarray, *own: np.ndarray) -> pa.RecordBatch:
    """Rows of ``BLOCK_SCHEMA`` for columns in the order of ``vid``, which comes once."""
    block = vid // size
    starts = _starts(block)
    places = np.append(starts, len(vid))
    return pa.RecordBatch.from_arrays([pa.array(block[starts]), _pieces(places, vid, u, f), _pieces(places, *own)], ["block", "sums", "own"])


def blocks_of_sums(size: int):
    """:func:`sums_by_target`, its rows put together by blocks of ``size`` vertex numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sums_by_target(batches):
            yield _blocks(size, *(batch.column(c).to_numpy() for c in ("vid", "u", "f")))
    return run


def blocks_of_rows(size: int):
    """Vertices' own rows, ``(vid, u, f, ...)`` with further columns of 8 bytes, put together by blocks as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, lambda b: b.num_rows):
            order = np.argsort(_column(table, "vid"), kind="stable")
            columns = [_column(table, c)[order] for c in table.column_names]
            for a in range(0, len(order), ROWS_OUT):
                yield _blocks(size, *(c[a:a + ROWS_OUT] for c in columns))
    return run


def rows_of_blocks(size: int, own: list[tuple[str, str]]):
    """Rows of ``BLOCK_SCHEMA``, all those of a block in one task, to a row per vertex:
    ``vid``, the sums of ``u`` and ``f``, and the columns ``own`` of its own row (null if it has none).

    A task holds the sums and own columns of its blocks, about 8 bytes a value:
    as much as those vertices' own rows take in the exchange.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for block, sums, rest in zip(*(batch.column(c).to_pylist() for c in ("block", "sums", "own"))):
                if block not in held:
                    held[block] = (np.zeros((2, size), np.int64), [np.zeros(size, t) for _, t in own], np.zeros((2, size), bool))
                total, columns, met = held[block]
                vid, u, f = np.frombuffer(sums, "<i8").reshape(3, -1)
                at = vid - block * size
                # A vertex comes once in a row, so that plain indexing adds each share.
                total[0, at] += u
                total[1, at] += f
                met[0, at] = True
                if rest:
                    met[1, at] = True
                    for column, piece in zip(columns, np.frombuffer(rest, "<i8").reshape(len(own), -1)):
                        column[at] = piece.view(column.dtype)
        for block in sorted(held):
            total, columns, met = held.pop(block)
            found = np.flatnonzero(met[0])
            none = ~met[1, found] if not met[1, found].all() else None
            for a in range(0, len(found), ROWS_OUT):
                at, gap = found[a:a + ROWS_OUT], None if none is None else none[a:a + ROWS_OUT]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at + block * size), pa.array(total[0, at]), pa.array(total[1, at]), *(pa.array(c[at], mask=gap) for c in columns)],
                    ["vid", "u", "f", *(name for name, _ in own)])
    return run
