"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkgraph.session import remove_path, written

#: White space that ends a word: space and U+0009 to U+000D, nothing else.
#: ``bytes.split()`` splits at exactly these characters.
SPACES = " \t\n\v\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: what reads the result survives the loss of any executor
    without recomputing ``df``.
    """
    return saved_at(df, kind)[0]


def saved_at(df: DataFrame, kind: str) -> tuple[DataFrame, str]:
    """As ``saved``, with the path, for tables that can go before the job ends."""
    out, path = written(df, kind)
    paths = _PATHS.get()
    if paths is not None:
        paths.append(path)
    return out, path


_PATHS: ContextVar[list[str] | None] = ContextVar("saved_paths", default=None)


@contextmanager
def saved_tables_removed(spark: SparkSession) -> Iterator[None]:
    """Removes what ``saved`` writes inside the block once the block ends, also by an error.

    Results that are to live on have to be written by then, by other means:
    what is still lazy loses what it reads.
    """
    paths: list[str] = []
    token = _PATHS.set(paths)
    try:
        yield
    finally:
        _PATHS.reset(token)
        for path in paths:
            remove_path(spark, path)


def word_count(text: Column) -> Column:
    """Words of a text, by the words' definition; 0 for null and blank texts."""
    trimmed = F.btrim(text, F.lit(SPACES))
    n = F.size(F.split(trimmed, WORD_GAP)).cast("long")
    return F.when(text.isNull() | (trimmed == ""), F.lit(0).cast("long")).otherwise(n)


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


#: Bytes that belong to a term (0-9, a-z, A-Z as a-z, and all past ASCII); others end it.
_TERM_BYTES = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The search terms of a text: runs of letters, digits and characters past
    U+007F, only A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def slices(parts: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, for work that holds them as Python objects."""
    for part in parts:
        for at in range(0, part.num_rows, rows):
            yield part.slice(at, rows)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# --- hashes of words and of runs of words, as wrapping 64-bit arithmetic -----

_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd, so that it has an inverse modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (byte offsets, end exclusive) and a hash of every word."""
    raw = np.frombuffer(text, dtype=np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return start, end, np.empty(0, np.uint64)
    # Polynomial hash by prefix sums: the sum over a word, moved to power 0.
    n = int(end[-1])
    power, unpower = _powers(_BASE, n), _powers(_UNBASE, n)
    total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[raw[:n]] * power, dtype=np.uint64)))
    return start, end, mixed((total[end] - total[start]) * unpower[start] + (end - start).astype(np.uint64))


def run_hashes(words: np.ndarray, k: int, base: int = int(_BASE)) -> np.ndarray:
    """A hash of every run of ``k`` consecutive word hashes."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    power = _powers(np.uint64(base), len(words))
    unpower = _powers(np.uint64(pow(base, -1, 2**64)), len(words))
    total = np.concatenate(([np.uint64(0)], np.cumsum(words * power, dtype=np.uint64)))
    return mixed((total[k:] - total[:-k]) * unpower[: len(words) - k + 1])
