"""Quality rules: base counts of a text, and compression bands.

A text is judged by how well zstandard compresses it, as a whole and in fixed
chunks: a ratio (compressed / raw bytes) under a band's low end marks
repetitive text, one over its high end text that is not language (keys, noise,
encoded data). Short texts compress worse, so each length class has its band.

``fit_bands`` sets the bands from every document that labels call clean: the
ratios of each length class without its outer ``tail`` on either side, widened by
a share of the limit. A class with fewer than ``MIN_ROWS`` clean texts keeps its
wide default. The margins are wide because a table's clean texts say little about
others: prose of one generator lies within a few hundredths, licences and release
notes far below. The percentiles are exact: the ratios of all clean texts are
range-sorted and numbered (``operators.numbering``), and the driver reads those at
the wanted places only, whatever the number of texts. ``judge_fitted`` fits and
judges with one measurement of each text.

Whole texts are read; each is judged alone in one pass, without a shuffle of texts:
a fit moves a few numbers per document.

Cases: null and blank texts have no words and fail the base rules; bands apply
to texts of any length; the last chunk is the last ``CHUNK`` bytes and may
overlap the one before, and a text of up to ``CHUNK`` bytes has no chunk but
the whole; rows are kept as they come, repeated or not,
with null ids or not; an empty table gives an empty result, and empty labels the
wide bands; a labelled id of several rows counts with all of them; ``judge``
ignores other columns, ``keep_good`` keeps them, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from linkgraph.llm.common import saved_at
from linkgraph.operators.numbering import numbered
from linkgraph.session import remove_path

LEVEL = 3
CHUNK = 4096
MIN_WORDS = 50
#: The fewest clean texts that set a class's band.
MIN_ROWS = 20
#: Share of a class's clean texts that a fit leaves out on either side, and by what
#: share of itself the lowest and the highest of the others is widened.
TAIL, LOW_MARGIN, HIGH_MARGIN = 0.01, 0.6, 0.25


@dataclass(frozen=True)
class Bands:
    """(bytes below which the band holds, lowest and highest whole-text ratio) by
    rising length, and the lowest and highest ratio of any chunk."""

    whole: tuple[tuple[int | None, float, float], ...]
    chunk: tuple[float, float]

    def hold(self, size: int, ratio: float, lowest: float | None, highest: float | None) -> bool:
        low, high = next((lo, hi) for top, lo, hi in self.whole if top is None or size < top)
        return low <= ratio <= high and (lowest is None or lowest >= self.chunk[0] and highest <= self.chunk[1])

    def kept(self) -> Column:
        """The verdict on a row of ``judge`` with its ``size``: as ``hold``, for texts that pass the base rules."""
        inside = F.lit(False)
        for top, low, high in reversed(self.whole):
            within = F.col("ratio").between(low, high)
            inside = within if top is None else F.when(F.col("size") < top, within).otherwise(inside)
        chunks = F.col("lowest_chunk").isNull() | (F.col("lowest_chunk") >= self.chunk[0]) & (F.col("highest_chunk") <= self.chunk[1])
        return ~F.col("base_failed") & inside & chunks


WIDE = Bands(((128, 0.30, 1.30), (256, 0.33, 1.00), (512, 0.30, 0.90), (768, 0.28, 0.85), (1024, 0.26, 0.80), (1536, 0.24, 0.75),
              (2048, 0.24, 0.70), (3072, 0.22, 0.66), (4096, 0.22, 0.64), (5120, 0.20, 0.62), (6144, 0.20, 0.61), (8192, 0.20, 0.60),
              (12288, 0.20, 0.59), (16384, 0.20, 0.58), (32768, 0.18, 0.57), (None, 0.15, 0.56)), (0.15, 0.64))

_GAPS, _SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"

FIELDS = (("n_words", pa.int64(), "long"), ("word_chars", pa.int64(), "long"), ("n_symbols", pa.int64(), "long"),
          ("n_dup_lines", pa.int64(), "long"), ("n_repeat_words", pa.int64(), "long"),
          ("base_failed", pa.bool_(), "boolean"), ("ratio", pa.float64(), "double"),
          ("lowest_chunk", pa.float64(), "double"), ("highest_chunk", pa.float64(), "double"),
          ("kept", pa.bool_(), "boolean"))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    again = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(times[window] > 1)
    np.add.at(again, at, 1)
    np.add.at(again, at + 3, -1)
    return int(np.count_nonzero(np.cumsum(again)))


def repeated_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip(_GAPS)]
    return len(lines) - len(set(lines))


def measure(text: str | None, pack: zstandard.ZstdCompressor, bands: Bands = WIDE) -> tuple:
    """The values of ``FIELDS`` for one text."""
    raw = (text or "").encode()
    words = raw.split()
    gaps = len(raw) - len(raw.translate(None, _GAPS))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeat > 50 * len(words)
    ratio = len(pack.compress(raw)) / max(len(raw), 1)
    starts = [*range(0, len(raw) - CHUNK, CHUNK), len(raw) - CHUNK] if len(raw) > CHUNK else []
    ratios = [len(pack.compress(raw[i:i + CHUNK])) / CHUNK for i in starts]
    lowest, highest = min(ratios, default=None), max(ratios, default=None)
    return (len(words), len(text or "") - gaps, symbols, repeated_lines(raw), repeat, failed, ratio, lowest, highest,
            not failed and bands.hold(len(raw), ratio, lowest, highest))


def fit_bands(docs: DataFrame, labels: DataFrame, sample: int | None = None, tail: float = TAIL, low_margin: float = LOW_MARGIN,
              high_margin: float = HIGH_MARGIN) -> Bands:
    """Bands for the clean texts of ``docs``: ``labels`` holds (doc_id, quality), 1 for clean.
    ``sample``: look at so many labelled ids at most (by a hash), not at all."""
    rows, path = _measured(docs)
    bands = _fitted(rows, labels, sample, tail, low_margin, high_margin)
    remove_path(docs.sparkSession, path)
    return bands


def judge_fitted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with the bands that ``fit_bands`` sets; each text is measured once."""
    rows, _ = _measured(docs)
    return rows.withColumn("kept", _fitted(rows, labels).kept()).drop("size")


def _measured(docs: DataFrame) -> tuple[DataFrame, str]:
    """``judge`` with ``size`` (bytes) for every row of ``docs``, written, and its path."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    return saved_at(judge(docs.select("doc_id", "text", size.alias("size")), WIDE, "size"), "quality")


def _fitted(rows: DataFrame, labels: DataFrame, sample: int | None = None, tail: float = TAIL, low_margin: float = LOW_MARGIN,
            high_margin: float = HIGH_MARGIN) -> Bands:
    """The bands for rows of ``_measured``."""
    asked = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    if sample is not None:
        asked = asked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    clean = rows.where("not base_failed").join(asked, "doc_id", "left_semi")
    tops = [top for top, _, _ in WIDE.whole if top is not None]
    lowest, highest = len(WIDE.whole), len(WIDE.whole) + 1      # after the classes' ratios, those of chunks
    number = sum((F.when(F.col("size") >= top, 1).otherwise(0) for top in tops), F.lit(0))
    values = clean.select(F.explode(F.array(*(F.struct(kind.alias("kind"), F.col(c).alias("value")) for kind, c in (
        (number, "ratio"), (F.lit(lowest), "lowest_chunk"), (F.lit(highest), "highest_chunk"))))).alias("v")).select("v.*")
    placed, path = numbered(values.where("value is not null"), "place", F.col("kind"), F.col("value"), kind="quality-ratios")
    # A row per class, then a few per class, reach the driver.
    count = {r["kind"]: r["n"] for r in placed.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = {kind: sum(n for k, n in count.items() if k < kind) for kind in count}
    at = {(kind, p): (n - 1) * p for kind, n in count.items() if n >= MIN_ROWS for p in (tail, 1 - tail)}
    places = sorted({first[kind] + end for (kind, _), x in at.items() for end in (math.floor(x), math.ceil(x))})
    value = {r["place"]: r["value"] for r in placed.where(F.col("place").isin(places)).collect()} if places else {}
    remove_path(rows.sparkSession, path)

    def percentile(kind: int, p: float) -> float:
        x = at[kind, p]
        low, high = value[first[kind] + math.floor(x)], value[first[kind] + math.ceil(x)]
        return low if low == high else (math.ceil(x) - x) * low + (x - math.floor(x)) * high

    whole = list(WIDE.whole)
    for kind, (top, _, _) in enumerate(WIDE.whole):
        if (kind, tail) in at:
            whole[kind] = (top, percentile(kind, tail) * (1 - low_margin), percentile(kind, 1 - tail) * (1 + high_margin))
    if (lowest, tail) not in at:
        return Bands(tuple(whole), WIDE.chunk)
    return Bands(tuple(whole), (percentile(lowest, tail) * (1 - low_margin), percentile(highest, 1 - tail) * (1 + high_margin)))


def judge(docs: DataFrame, bands: Bands = WIDE, *extra: str) -> DataFrame:
    """(doc_id, then ``FIELDS``) for every row of ``docs``, then its columns of whole numbers named in ``extra``."""
    schema = pa.schema([("doc_id", pa.int64()), *((n, t) for n, t, _ in FIELDS), *((c, pa.int64()) for c in extra)])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for part in parts:
            rows = [measure(t.as_py(), pack, bands) for t in part.column(1)]
            columns = list(zip(*rows)) if rows else [[] for _ in FIELDS]
            given = [part.column(2 + i) for i in range(len(extra))]
            yield pa.record_batch([part.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])), *given], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text", *(F.col(c).cast("long") for c in extra)).mapInArrow(
        run, ", ".join(["doc_id long", *(f"{n} {t}" for n, _, t in FIELDS), *(f"{c} long" for c in extra)]))


def keep_good(docs: DataFrame, bands: Bands = WIDE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    columns = docs.columns
    text_at = columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for part in parts:
            kept = pa.array([measure(t.as_py(), pack, bands)[-1] for t in part.column(text_at)], pa.bool_())
            yield part.filter(kept)

    return docs.mapInArrow(run, docs.schema)
