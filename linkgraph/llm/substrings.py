"""Substring dedup by relative Lempel-Ziv parsing against reference blocks.

A window is ``WINDOW`` consecutive words of one document. A word goes if some
window that covers it also starts in a document with a smaller ``doc_id``.

Method. Of every window, the run of ``ANCHOR`` words with the smallest hash
(the leftmost, if tied) is its anchor, so equal windows have equal anchors; a
document has one about every 18 words. The anchors that occur in more than one
document index the references: the first document with an anchor (smallest id)
is its reference, read in blocks of ``BLOCK`` words. A document is parsed
against each block that shares anchors with it: at the next anchor, the match
with the block is extended as far as it goes on both sides, which is a factor;
anchors inside it on the same alignment are used up. A factor of ``WINDOW``
words or more is a duplicate span. What an anchor's windows hold beyond a
factor's boundaries may still repeat a third document: those windows, and only
those, are checked exactly, by 128 bits of hash over all documents. All holders
of such a window differ from the reference there, so all are in that check.

Scale. Anchors (a few per cent of the words, 8 bytes each) are shuffled, not
windows or pairs; first occurrences are partial minima. Only documents with a
shared anchor move their text on, in segments that meet one reference block at
a time, so copies cost their own length, whatever the number of copies. Hot
anchors and blocks are join keys on plain joins, whose large sides can be split.

Cases: null and blank texts have no words; texts of fewer than ``WINDOW`` words
lose none; a null ``doc_id`` is neither smaller nor larger than another, so its
row stays whole and removes nothing; rows that share a ``doc_id`` are each
judged against smaller ids only; an empty table gives an empty result; extra
columns are kept by ``remove_repeats`` and ignored by the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkgraph.llm.common import batches, byte_texts, run_hashes, saved, slices, word_hashes

WINDOW = 50
ANCHOR = 16
BLOCK = 256
#: Words of a segment that lie between two anchors at most.
GAP = 64
_SECOND_BASE = 0xD6E8FEB86659FD93


def anchors(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(position, hash, first window, last window) of each anchor of a text.

    ``words`` are word hashes. An anchor's windows are those it is chosen for.
    """
    runs = run_hashes(words, anchor)
    width = window - anchor + 1
    if len(runs) < width:
        none = np.empty(0, np.int64)
        return none, np.empty(0, np.uint64), none, none
    views = np.lib.stride_tricks.sliding_window_view(runs, width)
    step = 1 << 14  # windows at a time: argmin copies what it looks at
    at = np.concatenate([views[i:i + step].argmin(axis=1) + np.arange(i, min(i + step, len(views)))
                         for i in range(0, len(views), step)])
    position, first, count = np.unique(at, return_index=True, return_counts=True)
    return position, runs[position], first, first + count - 1


def anchor_table(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(ah, doc_id, pos) of every anchor."""
    schema = pa.schema([("ah", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            hashes, ids, places = [], [], []
            for doc_id, text in zip(part.column(0).to_pylist(), byte_texts(part.column(1))):
                position, found, _, _ = anchors(word_hashes(text)[2], window, anchor)
                hashes.append(found.view(np.int64))
                places.append(position.astype(np.int32))
                ids.append(np.full(len(position), doc_id, np.int64))
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in (hashes, ids, places)], schema=schema)

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(run, "ah long, doc_id long, pos int")


def sharers(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, th, text, seeds) of the documents with a shared anchor.

    ``seeds``: (ah, ref, at): shared anchors, their reference and where it has them.
    """
    found = saved(anchor_table(docs, window, anchor), "substrings-anchors")
    first = (found.groupBy("ah").agg(F.min("doc_id").alias("ref"), F.max("doc_id").alias("last"), F.min_by("pos", "doc_id").alias("at"))
             .where("ref < last").select("ah", "ref", "at"))
    # Written, so that both sides of the join are plain: a hot anchor's rows can be split.
    seeds = found.select("ah", "doc_id").join(saved(first, "substrings-first"), "ah")
    per_doc = seeds.groupBy("doc_id").agg(F.collect_set(F.struct("ah", "ref", "at")).alias("seeds"))
    # The narrow side is hashed, so that texts need no sort.
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").join(per_doc.hint("shuffle_hash"), "doc_id")
    return saved(rows, "substrings-sharers")


def reference_blocks(rows: DataFrame, window: int, anchor: int, block: int) -> DataFrame:
    """(ref, block, ref_start, ref_text): the blocks that hold a reference anchor.

    A block reaches ``window - anchor`` words past the anchors in it, both ways.
    """
    schema = pa.schema([("ref", pa.int64()), ("block", pa.int32()), ("ref_start", pa.int32()), ("ref_text", pa.binary())])
    margin = window - anchor

    def blocks(part: pa.RecordBatch) -> Iterator[tuple]:
        for doc_id, text, own in zip(part.column(0).to_pylist(), byte_texts(part.column(1)), part.column(2).to_pylist()):
            words, runs = text.split(), run_hashes(word_hashes(text)[2], anchor).view(np.int64)
            held = {s["at"] // block for s in own if s["at"] < len(runs) and runs[s["at"]] == s["ah"]}
            for b in sorted(held):
                start = max(0, b * block - margin)
                yield doc_id, b, start, b" ".join(words[start:(b + 1) * block + window])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            yield from batches(blocks(part), schema, 5000)

    own = rows.select("doc_id", "text", F.filter("seeds", lambda s: s["ref"] == F.col("doc_id")).alias("own")).where(F.size("own") > 0)
    return own.mapInArrow(run, "ref long, block int, ref_start int, ref_text binary")


def segments(rows: DataFrame, window: int, anchor: int, block: int) -> DataFrame:
    """(ref, block, doc_id, th, start, text, p, q, first, last): what meets a block.

    A segment holds neighbouring anchors (``p``, at ``q`` in the reference) with
    all their windows (from ``first`` to ``last``), in words of the document.
    """
    ints = pa.list_(pa.int32())
    schema = pa.schema([("ref", pa.int64()), ("block", pa.int32()), ("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int32()),
                        ("text", pa.binary()), ("p", ints), ("q", ints), ("first", ints), ("last", ints)])

    def cut(part: pa.RecordBatch) -> Iterator[tuple]:
        columns = part.column(0).to_pylist(), part.column(1).to_pylist(), byte_texts(part.column(2)), part.column(3).to_pylist()
        for doc_id, th, text, seeds in zip(*columns):
            words, known = text.split(), {s["ah"]: (s["ref"], s["at"]) for s in seeds}
            position, found, first, last = anchors(word_hashes(text)[2], window, anchor)
            open_at: dict[tuple, list] = {}
            for p, ah, a, z in zip(position.tolist(), found.view(np.int64).tolist(), first.tolist(), last.tolist()):
                ref, q = known.get(ah, (None, None))
                if ref is None or ref == doc_id and q == p:
                    continue
                key = (ref, q // block)
                held = open_at.get(key)
                if held and p - held[-1][0] > GAP:
                    yield segment(key, doc_id, th, words, held)
                    held = None
                if not held:
                    held = open_at[key] = []
                held.append((p, q, a, z))
            for key, held in open_at.items():
                yield segment(key, doc_id, th, words, held)

    def segment(key: tuple, doc_id: int, th: int, words: list, held: list) -> tuple:
        start = held[0][2]
        return (*key, doc_id, th, start, b" ".join(words[start:held[-1][3] + window]), *map(list, zip(*held)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            yield from batches(cut(part), schema, 5000)

    return rows.select("doc_id", "th", "text", "seeds").mapInArrow(
        run, "ref long, block int, doc_id long, th long, start int, text binary, p array<int>, q array<int>, first array<int>, last array<int>")


def parse(seg: list[bytes], start: int, ref: list[bytes], ref_start: int, seeds: list[tuple], window: int = WINDOW,
          anchor: int = ANCHOR) -> tuple[list[tuple[int, int]], list[int]]:
    """Greedy factors of a segment against a block: (spans, windows left over).

    Spans are ranges of words covered by whole windows inside a factor; windows
    left over are the anchors' windows that no factor holds, by their start.
    """
    spans, rest = [], []
    lo = hi = align = None
    for p, q, first, last in seeds:
        if align != p - q or not lo <= p < hi:
            a, b = p - start, q - ref_start
            left = 0
            while left < a and left < b and seg[a - left - 1] == ref[b - left - 1]:
                left += 1
            right, most = 0, min(len(seg) - a, len(ref) - b)
            while right < most and seg[a + right] == ref[b + right]:
                right += 1
            lo, hi, align = p - left, p + right, p - q
            if right < anchor:  # equal hashes of unlike words
                lo = hi = p
                align = None
        begin, end = max(first, lo), min(last, hi - window)
        if begin > end:
            rest.extend(range(first, last + 1))
        else:
            spans.append((begin, end + window))
            rest.extend(range(first, begin))
            rest.extend(range(end + 1, last + 1))
    return spans, rest


def factors(rows: DataFrame, window: int, anchor: int, block: int) -> DataFrame:
    """(doc_id, th, start, end, h1, h2): duplicate spans, and windows left over (h1, h2: their hash)."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])

    def parsed(part: pa.RecordBatch) -> Iterator[tuple]:
        for row in range(part.num_rows):
            ref, ref_start, ref_text, doc_id, th, start, text, p, q, first, last = (c[row].as_py() for c in part.columns)
            spans, rest = parse(text.split(), start, ref_text.split(), ref_start, list(zip(p, q, first, last)), window, anchor)
            if ref < doc_id:
                for a, z in spans:
                    yield doc_id, th, a, z, None, None
            if rest:
                words = word_hashes(text)[2]
                h1, h2 = run_hashes(words, window).view(np.int64), run_hashes(words, window, _SECOND_BASE).view(np.int64)
                for w in rest:
                    yield doc_id, th, w, w + window, int(h1[w - start]), int(h2[w - start])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            yield from batches(parsed(part), schema)

    blocks = reference_blocks(rows, window, anchor, block)
    meets = segments(rows, window, anchor, block).join(blocks.hint("shuffle_hash"), ["ref", "block"])
    columns = ["ref", "ref_start", "ref_text", "doc_id", "th", "start", "text", "p", "q", "first", "last"]
    return saved(meets.select(*columns).mapInArrow(run, "doc_id long, th long, start int, end int, h1 long, h2 long"), "substrings-factors")


def changed_documents(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK) -> DataFrame:
    """(doc_id, th, n_words, n_removed, kept): the documents that lose words.

    ``th`` is xxhash64 of the text; ``kept`` the kept words joined by one space.
    Rows that share ``doc_id`` and text are one row here.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = sharers(docs, window, anchor)
    found = factors(rows, window, anchor, block)
    left = found.where("h1 is not null")
    again = left.groupBy("h1", "h2").agg(F.min("doc_id").alias("ref"), F.max("doc_id").alias("last_id")).where("ref < last_id").drop("last_id")
    again = saved(again, "substrings-again")
    spans = found.where("h1 is null").select("doc_id", "th", "start", "end").unionByName(
        left.join(again, ["h1", "h2"]).where("doc_id > ref").select("doc_id", "th", "start", "end"))
    per_doc = spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def cut(part: pa.RecordBatch) -> Iterator[tuple]:
        for doc_id, th, text, gone in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), byte_texts(part.column(2)), part.column(3).to_pylist()):
            words = text.split()
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, [s["start"] for s in gone], 1)
            np.add.at(edge, [s["end"] for s in gone], -1)
            stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
            yield doc_id, th, len(words), len(words) - len(stay), b" ".join([words[i] for i in stay]).decode()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            yield from batches(cut(part), schema, 1000)

    texts = rows.select("doc_id", "th", "text").join(per_doc.hint("shuffle_hash"), ["doc_id", "th"])
    cleaned = texts.mapInArrow(run, "doc_id long, th long, n_words long, n_removed long, kept string")
    return cleaned.dropDuplicates(["doc_id", "th"])


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without repeated words: texts that lose words become the kept
    words joined by one space, all others stay as they are."""
    changed = changed_documents(docs, **options).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("kept").alias("__kept"))
    rows = docs.join(changed, (docs["doc_id"] == F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__th")), "left")
    return rows.withColumn("text", F.coalesce("__kept", "text")).select(*docs.columns)
