"""Dense row numbers without a window over the whole table.

``row_number()`` over everything brings all rows to one task. Here rows are
written once where they are (or range-sorted, when an order is asked for), each
with its partition and its place in it; the partitions' row counts, one small
row per partition, become offsets by a prefix sum, and a row's number is its
partition's offset plus its place. Written rows keep their places, whatever
tasks are retried later.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

# ``monotonically_increasing_id`` keeps the partition above these bits, the place below.
_PLACE_BITS = 33
PLACE = "__place"


def numbered(df: DataFrame, name: str, *order: Column, kind: str = "numbered", path: str | None = None) -> tuple[DataFrame, str]:
    """``df`` with a column ``name`` of 0 … n-1, and the path it was written to.

    With ``order`` the numbers follow that order (rows that tie in all of it
    are numbered in any order); without, they follow the partitions as they are
    and nothing is shuffled. What reaches the driver: a row per partition.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed, path = written(df.withColumn(PLACE, F.monotonically_increasing_id()), kind, path)
    return with_numbers(placed, name), path


def with_numbers(placed: DataFrame, name: str) -> DataFrame:
    """The numbers of rows that :func:`numbered` wrote (again, from the same places)."""
    part = F.shiftright(PLACE, _PLACE_BITS)
    counts = dict(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect())
    offsets, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    # A literal of the plan: a number for each partition of the write.
    offset = F.get(F.from_json(F.lit(json.dumps(offsets)), "array<bigint>"), part.cast("int"))
    place = F.col(PLACE).bitwiseAND((1 << _PLACE_BITS) - 1)
    return placed.select(*[c for c in placed.columns if c != PLACE], (offset + place).alias(name))
