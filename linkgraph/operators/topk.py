"""Top-k report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import TOP_K, ranked_line
from ..session import written
from .numbering import numbered

# Most rows that one task merges for a top-k.
LARGE_K = 100_000
# Accuracy of the quantile sketch: its rank error is about 1 / SKETCH.
SKETCH = 10_000


def top_k(ranks: DataFrame, k: int = TOP_K, exclude: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The ``k`` highest ranks as ``(name, rank)``, rank descending, then name.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own best ``k`` rows and a single final step merges those — the
    two-stage bounded top-k, with at most k rows per task ever moved.
    ``exclude`` drops names before ranking (P13); fewer than k rows → all rows.
    Above ``LARGE_K`` that final step would be one large task, so
    :func:`_top_many` takes over: same rows, same order.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    named = ranks.select(F.col("id").alias("name"), "rank") if "id" in ranks.columns else ranks
    if exclude:
        named = named.where(~F.col("name").isin(list(exclude)))
    if k > LARGE_K:
        return _top_many(named, int(k))
    return named.orderBy(F.desc("rank"), F.asc("name")).limit(int(k))


def _top_many(named: DataFrame, k: int) -> DataFrame:
    """A top-k too large for one place.

    A quantile sketch of the ranks gives a rank that a little over k rows reach;
    an exact count of those rows tells if they are k at least, and lowers it if
    not. Only they are range-sorted and numbered, and the first k stay.
    """
    rows, _ = written(named.select("name", "rank"), "top-ranks")
    n = rows.count()
    width, reach = 2.0 / SKETCH, rows
    while n > k:
        place = 1.0 - k / n - width
        if place <= 0:
            break
        low = rows.agg(F.percentile_approx("rank", F.lit(place), F.lit(SKETCH))).first()[0]
        reach = rows.where(F.col("rank") >= low)
        if reach.count() >= k:
            break
        width, reach = width * 8, rows
    order = (F.desc("rank"), F.asc("name"))
    placed, _ = numbered(reach, "place", *order, kind="top-placed")
    return placed.where(F.col("place") < k).select("name", "rank").orderBy(*order)


def format_ranked(ranked: DataFrame, decimals: int | None = None) -> DataFrame:
    """``(value)`` lines ``name rank``, ordered by rank (then name).
    Takes a top-k ``(name, rank)`` or a whole rank table ``(id, rank)``."""
    if "name" not in ranked.columns:
        ranked = ranked.withColumnRenamed("id", "name")
    return (ranked.orderBy(F.desc("rank"), F.asc("name"))
            .select(ranked_line("name", "rank", decimals).alias("value")))
