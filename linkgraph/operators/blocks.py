"""Names to vertex numbers, for all links at once, by blocks of name keys.

A name's key is a 64-bit hash; a block is a range of keys. The links are read once,
next to where they come from, and written as keys, with each name once for the
``LINKS_AT_ONCE`` ends it is met in (:func:`keyed`). Then one shuffle brings the names
of a block together (:func:`names_by_block`, :func:`names_of_block`: a name's place in
its block, plus the block's offset, is its vertex number), one the links by their
targets (:func:`links_by_target`, :func:`links_by_source`) and one by their sources
(:func:`lists_of_sources`). Links move as two numbers of 8 bytes, many to a row.

Different names with one key are found where the names meet (``clash``). Vertices with a
large share of the links (``Hot``) are known from that step: their links go to
any block, by the other end, so that no block gets all links of such a vertex.

These functions run under ``mapInArrow``; a task holds ``LINKS_AT_ONCE`` links, or the
names or links of one block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from .links import LINKS_AT_ONCE, LINKS_OUT, ROWS_OUT, _chunks, _lists, _sorted_by, _starts, _targets, list_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Links as keys (``a`` and ``b``) and repeats (``c``), or names with their keys and the links they begin and end.
KEYED = "a binary, b binary, c binary, listed boolean, keys binary, lengths binary, text binary, outs binary, ins binary"
NAMES_MOVING = "block int, listed boolean, keys binary, lengths binary, text binary, outs binary, ins binary"
NAMES = "block int, place bigint, key bigint, id string, listed boolean, outs bigint, ins bigint, clash boolean"
LINKS_MOVING = "block int, kind int, a binary, b binary, c binary"
# Merged links as target lists, one row per source and number of repeats (``n`` targets), and rows that
# only count a vertex's sources. Degrees are null where a source's links lie in several tasks.
MERGED = "vid bigint, mult bigint, out_degree bigint, n_targets bigint, n bigint, n_sources bigint, dst_vids binary"
# Kinds of moving rows: keys of a block; links by the key of the end looked up (a) or by its
# number among the hot vertices (a), with the other end (b) and the repeats (c); numbers (a) and source counts (b).
KEYS, LINKS, KNOWN, COUNTS = range(4)


@dataclass
class Hot:
    """Vertices with a large share of the links, by key: a bounded table."""

    keys: np.ndarray
    vids: np.ndarray


def block_of(key: np.ndarray, blocks: int) -> np.ndarray:
    """The block, of 0 … blocks-1, of unsigned 64-bit keys: equal ranges in ascending order."""
    return (((key >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def spread(number: np.ndarray, parts) -> np.ndarray:
    """One of ``parts`` for each number, evenly."""
    mixed = number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (((mixed >> np.uint64(32)) * np.asarray(parts, np.uint64)) >> np.uint64(32)).astype(np.int64)


def _values(rows: list[bytes], dtype: str = "<i8") -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype)


def _cut(places: np.ndarray, column: np.ndarray) -> pa.Array:
    """One value for each of ``places[i]:places[i + 1]``."""
    raw = np.ascontiguousarray(column)
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer((places * raw.itemsize).astype(np.int32)), pa.py_buffer(raw)])


def _cut_text(offsets: np.ndarray, data: pa.Buffer | None) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data or pa.py_buffer(b"")])


def _cut_repeats(places: np.ndarray, mult: np.ndarray) -> pa.Array:
    """Repeats take no bytes where all are 1, and one where they fit it."""
    if (mult == 1).all():
        return pa.nulls(len(places) - 1, pa.binary())
    return _cut(places, mult.astype(np.uint8) if mult.min() >= 0 and mult.max() < 256 else mult)


def _repeats(a: list[bytes], c: list[bytes | None]) -> np.ndarray:
    """What :func:`_cut_repeats` cut, beside columns ``a`` of 8 bytes."""
    cut = [np.ones(len(x) // 8, np.int64) if y is None else np.frombuffer(y, "<i8" if len(y) == len(x) else "u1").astype(np.int64) for x, y in zip(a, c)]
    return np.concatenate([*cut, np.empty(0, np.int64)])


def _text(offsets: np.ndarray, data: pa.Buffer) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), data])


def _batch(schema: str, **columns) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c]) for c in names], names)


# --- names --------------------------------------------------------------------------------

def keyed(listed: bool = False):
    """Rows ``(src, dst, src_key, dst_key)``, maybe with ``mult``, or ``(id, key)`` of
    ``listed`` names, to ``KEYED``; names in the order of their keys, up to ``ROWS_OUT`` to a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ends are counted, long names as several.
        for table in _chunks(batches, lambda b: max(2 * b.num_rows, b.nbytes >> 5)):
            ends = [("id", "key")] if listed else [("src", "src_key"), ("dst", "dst_key")]
            met = pa.concat_arrays([c.cast(pa.large_binary()) for name, _ in ends for c in table[name].chunks]).dictionary_encode()
            at, names = met.indices.to_numpy(), met.dictionary
            end_keys = [table[key].to_numpy() for _, key in ends]
            keys = np.empty(len(names), np.uint64)
            keys[at] = np.concatenate(end_keys).view(np.uint64)
            n = 0 if listed else table.num_rows
            outs, ins = (np.bincount(x, minlength=len(names)) for x in (at[:n], at[n:] if n else at[:0]))
            order = np.argsort(keys)
            names = names.take(pa.array(order))
            ends_at = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1)
            places = np.append(np.arange(0, len(names), ROWS_OUT), len(names))
            none = pa.nulls(len(places) - 1, pa.binary())
            yield _batch(KEYED, a=none, b=none, c=none, listed=np.full(len(none), listed), keys=_cut(places, keys[order]),
                         lengths=_cut(places, np.diff(ends_at)), text=_cut_text(ends_at[places], names.buffers()[2]),
                         outs=_cut(places, outs[order]), ins=_cut(places, ins[order]))
            if not listed:
                places = np.append(np.arange(0, n, ROWS_OUT), n)
                none = pa.nulls(len(places) - 1, pa.binary())
                repeats = _cut_repeats(places, table["mult"].to_numpy()) if "mult" in table.column_names else none
                yield _batch(KEYED, a=_cut(places, end_keys[0]), b=_cut(places, end_keys[1]), c=repeats, listed=np.full(len(none), False),
                             keys=none, lengths=none, text=none, outs=none, ins=none)
    return run


def names_by_block(blocks: int):
    """Rows of ``KEYED`` that hold names to ``NAMES_MOVING``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], "<u8")
                block = block_of(keys, blocks)
                starts = _starts(block)
                places = np.append(starts, len(keys))
                ends_at = np.append(0, np.cumsum(np.frombuffer(row["lengths"], "<i8")))
                yield _batch(NAMES_MOVING, block=block[starts].astype(np.int32), listed=np.full(len(starts), row["listed"]),
                             text=_cut_text(ends_at[places], pa.py_buffer(row["text"])),
                             **{c: _cut(places, np.frombuffer(row[c], "<i8")) for c in ("keys", "lengths", "outs", "ins")})
    return run


def names_of_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of one block to ``NAMES``: each name once, in the order of the keys."""
    rows = [row for batch in batches for row in batch.to_pylist()]
    if not rows:
        return
    keys = _values([r["keys"] for r in rows], "<u8")
    offsets = np.append(0, np.cumsum(_values([r["lengths"] for r in rows])))
    names = _text(offsets, pa.py_buffer(b"".join(r["text"] for r in rows)))
    outs, ins = (_values([r[c] for r in rows]) for c in ("outs", "ins"))
    listed = np.repeat([r["listed"] for r in rows], [len(r["keys"]) // 8 for r in rows])
    block = rows[0]["block"]
    del rows
    order = np.argsort(keys)
    keys, names = keys[order], names.take(pa.array(order))
    starts = _starts(keys)
    differs = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
    clash = bool((differs & (keys[1:] == keys[:-1])).any())
    outs, ins = (np.add.reduceat(c[order], starts) for c in (outs, ins))
    listed = np.logical_or.reduceat(listed[order], starts)
    for a in range(0, len(starts), ROWS_OUT):
        at = slice(a, a + ROWS_OUT)
        n = len(starts[at])
        yield _batch(NAMES, block=np.full(n, block, np.int32), place=np.arange(a, a + n), key=keys[starts[at]].view(np.int64),
                     id=names.take(pa.array(starts[at])).cast(pa.binary()).view(pa.string()), listed=listed[at],
                     outs=outs[at], ins=ins[at], clash=np.full(n, clash))


# --- links --------------------------------------------------------------------------------

def _moving(block: np.ndarray, kind: int, a: np.ndarray, b: np.ndarray | None = None, c: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of ``LINKS_MOVING``, one per block."""
    if not len(a):
        return
    block, order = _sorted_by(block, np.arange(len(a)))
    starts = _starts(block)
    places = np.append(starts, len(a))
    none = pa.nulls(len(starts), pa.binary())
    yield _batch(LINKS_MOVING, block=block[starts].astype(np.int32), kind=np.full(len(starts), kind, np.int32), a=_cut(places, a[order]),
                 b=none if b is None else _cut(places, b[order]), c=none if c is None else _cut_repeats(places, c[order]))


def _held(batches: Iterator[pa.RecordBatch]) -> tuple[int, dict[int, tuple]]:
    """A block and its moved columns by kind."""
    block, held = -1, {kind: ([], [], []) for kind in (KEYS, LINKS, KNOWN, COUNTS)}
    for batch in batches:
        for block, kind, a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
            to = held[kind]
            to[0].append(a)
            to[1].append(b or b"")
            to[2].append(c)
    return block, {kind: (_values(a), _values(b), _repeats(a, c)) for kind, (a, b, c) in held.items()}


def _merged(place: np.ndarray, other: np.ndarray, mult: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links with the same ends (``place``, a small number, and ``other``) put together."""
    if not len(place):
        return place, other, mult
    by = np.argsort(other)
    place, row = _sorted_by(place[by], np.arange(len(by)))
    by = by[row]
    starts = _starts(place, other[by])
    return place[starts], other[by][starts], np.add.reduceat(mult[by], starts)


def _sent(key: np.ndarray, other: np.ndarray, mult: np.ndarray, blocks: int, hot: Hot) -> Iterator[pa.RecordBatch]:
    """Links to where ``key`` is looked up; those of hot vertices to any block."""
    key = key.view(np.uint64)
    at = np.minimum(np.searchsorted(hot.keys, key), max(len(hot.keys) - 1, 0))
    known = hot.keys[at] == key if len(hot.keys) else np.zeros(len(key), bool)
    if known.any():
        # One link may be repeated without end, between two such vertices.
        place, end, repeats = _merged(at[known], other[known], mult[known])
        yield from _moving(spread(end, blocks), KNOWN, place, end, repeats)
        key, other, mult = key[~known], other[~known], mult[~known]
    yield from _moving(block_of(key, blocks), LINKS, key, other, mult)


def keys_of_names(blocks: int):
    """Rows ``(key)`` to ``LINKS_MOVING``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, lambda b: b.num_rows):
            keys = table["key"].to_numpy().view(np.uint64)
            yield from _moving(block_of(keys, blocks), KEYS, keys)
    return run


def links_by_target(blocks: int, hot: Hot):
    """Rows ``(a, b, c)`` of ``KEYED`` that hold links to ``LINKS_MOVING``, by target."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, lambda x: pc.sum(pc.binary_length(x.column("a"))).as_py() // 8 if x.num_rows else 0):
            src, dst, repeats = (table[c].to_pylist() for c in "abc")
            yield from _sent(_values(dst), _values(src), _repeats(src, repeats), blocks, hot)
    return run


def _numbers(block: int, held: dict[int, tuple], offsets: np.ndarray, hot: Hot) -> tuple[np.ndarray, np.ndarray, int]:
    """The places of the ends looked up, the vertex number of each place, and the first place of a hot vertex."""
    keys = np.sort(held[KEYS][0].view(np.uint64))
    place = np.concatenate([np.searchsorted(keys, held[LINKS][0].view(np.uint64)), held[KNOWN][0] + len(keys)])
    return place, np.concatenate([offsets[block] + np.arange(len(keys)), hot.vids]), len(keys)


def links_by_source(blocks: int, offsets: np.ndarray, hot: Hot):
    """All rows of one block, links by target, to ``LINKS_MOVING`` by source:
    targets numbered, repeats merged, the targets' sources counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = _held(batches)
        if block < 0:
            return
        place, number, _ = _numbers(block, held, offsets, hot)
        other, mult = (np.concatenate([held[LINKS][i], held[KNOWN][i]]) for i in (1, 2))
        del held
        place, other, mult = _merged(place, other, mult)
        sources = np.bincount(place, minlength=len(number))
        met = np.flatnonzero(sources)
        yield from _moving(np.full(len(met), block), COUNTS, number[met], sources[met])
        yield from _sent(other, number[place], mult, blocks, hot)
    return run


def lists_of_sources(offsets: np.ndarray, hot: Hot):
    """All rows of one block, links by source, to ``MERGED``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = _held(batches)
        if block < 0:
            return
        vids, sources, _ = held[COUNTS]
        for a in range(0, len(vids), ROWS_OUT):
            n = len(vids[a:a + ROWS_OUT])
            none, zero = pa.nulls(n, pa.int64()), np.zeros(n, np.int64)
            yield _batch(MERGED, vid=vids[a:a + ROWS_OUT], mult=zero, out_degree=none, n_targets=none, n=zero,
                         n_sources=sources[a:a + ROWS_OUT], dst_vids=pa.nulls(n, pa.binary()))
        place, number, first_hot = _numbers(block, held, offsets, hot)
        other, mult = (np.concatenate([held[LINKS][i], held[KNOWN][i]]) for i in (1, 2))
        del held
        if not len(place):
            return
        place, row = _sorted_by(place, np.arange(len(place)))
        other, mult = other[row], mult[row]
        firsts = _starts(place)
        degree, targets = np.zeros((2, len(number)), np.int64)
        degree[place[firsts]] = np.add.reduceat(mult, firsts)
        targets[place[firsts]] = np.diff(np.append(firsts, len(place)))
        once = mult == 1
        for some in (once, ~once):
            p, m, dst = place[some], mult[some], other[some]
            if not len(p):
                continue
            if m.min() != m.max():
                by = np.lexsort((m, p))
                p, m, dst = p[by], m[by], dst[by]
            # A list of very many targets is cut, so that it moves in pieces.
            starts = np.union1d(_starts(p, m), np.arange(0, len(p), LINKS_OUT))
            at, n = p[starts], np.diff(np.append(starts, len(p)))
            for a, b, lists in list_rows(starts, dst):
                cold = at[a:b] < first_hot
                yield _batch(MERGED, vid=number[at[a:b]], mult=m[starts[a:b]], out_degree=pa.array(degree[at[a:b]], mask=~cold),
                             n_targets=pa.array(targets[at[a:b]], mask=~cold), n=n[a:b], n_sources=np.zeros(b - a, np.int64), dst_vids=lists)
    return run


def lists_by_bucket(split: int, hot: dict[int, tuple[int, int]]):
    """Rows of ``MERGED`` with targets to ``LIST_SCHEMA``: weighted, and the targets of a source with over
    ``split`` of them dealt over its buckets. ``hot``: out-degree and targets of the sources without."""
    vids = np.array(sorted(hot), np.int64)
    known = np.array([hot[v] for v in vids.tolist()], np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["src_vid", "bucket", "w", "dst_vids"]
        for table in _chunks(batches, lambda b: pc.sum(b.column("n")).as_py() if b.num_rows else 0):
            vid, mult = table["vid"].to_numpy(), table["mult"].to_numpy()
            degree, targets = (pc.fill_null(table[c], 0).to_numpy().copy() for c in ("out_degree", "n_targets"))
            lists = _lists(table["dst_vids"])
            gap = np.flatnonzero(table["out_degree"].is_null().to_numpy())
            if len(gap):
                degree[gap], targets[gap] = known[np.searchsorted(vids, vid[gap])].T
            w, nb = mult / degree, -(-targets // split)
            whole = np.flatnonzero(nb == 1)
            for a in range(0, len(whole), ROWS_OUT):
                at = whole[a:a + ROWS_OUT]
                yield pa.RecordBatch.from_arrays([pa.array(vid[at]), pa.array(np.zeros(len(at), np.int64)), pa.array(w[at]), lists.take(pa.array(at))], names)
            several = np.flatnonzero(nb > 1)
            if len(several):
                dst, row = _targets(lists.take(pa.array(several)))
                bucket = spread(dst, nb[several][row])
                most = int(nb[several].max())
                key, order = _sorted_by(row * most + bucket, np.arange(len(row)))
                starts = _starts(key)
                at, bucket = several[key[starts] // most], key[starts] % most
                for a, b, dealt in list_rows(starts, dst[order]):
                    yield pa.RecordBatch.from_arrays([pa.array(vid[at[a:b]]), pa.array(bucket[a:b]), pa.array(w[at[a:b]]), dealt], names)
    return run
