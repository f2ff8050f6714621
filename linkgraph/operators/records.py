"""Record split and name filter (P1, P2, P4) with a rejects report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import delimiter_pos, name_ok, record_body, record_name

# Record outcomes; the reject reasons are tested in this order.
OK = "ok"
NO_DELIMITER = "no_delimiter"
BAD_NAME = "bad_name"
ILL_FORMED = "ill_formed"


def split_records(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines ``name:html`` → ``(line, page, html, reason)``.

    ``reason`` is ``no_delimiter`` (no ``:``), ``bad_name`` (empty or holding a
    tilde) or null for a candidate page. The split is at the first ``:``; later
    ones stay in the html. A pure projection: it runs in the scan's stage.
    """
    line = F.col(line_col)
    reason = (F.when(delimiter_pos(line) == 0, F.lit(NO_DELIMITER))
              .when(~name_ok(record_name(line)), F.lit(BAD_NAME)))
    return lines.select(line.alias("line"), record_name(line).alias("page"),
                        record_body(line).alias("html"), reason.alias("reason"))


def reject_report(status: DataFrame) -> DataFrame:
    """``(reason, n)`` over a status table with a ``reason`` column
    (``ok`` for accepted records). Partial counts per task, one small exchange."""
    return status.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
