"""End-to-end jobs: ingest → rank → top-k, as the reference chains them.

One ingest pass reads the dump once: lines are split and name-checked in the
scan's stage, pages are parsed in the same stage by the Arrow extractor, and
the result — status, raw links and reject lines — is written once, as parquet.
The graph, the record count, the report and the rejects each read the columns
they need of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (ALPHA, CONTAINER, ITERATIONS, LINK_TARGET_PATTERN, NAV_CONTAINER,
                         NAV_LINK_PATTERN, TOP_K, name_ok)
from ..operators.extract import extract_links, link_rows
from ..operators.graph import Graph
from ..operators.rank import DEFAULT_SPLIT, rank_nodes
from ..operators.records import BAD_NAME, OK, reject_report, split_records
from ..operators.topk import top_k
from ..session import written
from ..sources import read_lines


@dataclass
class Ingested:
    extracted: DataFrame   # (page, reason, hrefs, line), one row per input record
    links: DataFrame       # (page, pos, href, target) of accepted pages
    graph: Graph

    def report(self) -> DataFrame:
        """``(reason, n)``; reason ``ok`` counts accepted records."""
        return reject_report(self.extracted)

    def rejects(self) -> DataFrame:
        """``(page, line, reason)`` of every rejected record (``line`` is null
        when the ingest did not keep rejected lines)."""
        return self.extracted.where(F.col("reason") != OK).select("page", "line", "reason")


def from_extracted(extracted: DataFrame, link_pattern: str = LINK_TARGET_PATTERN,
                   decode: bool = True, materialize: bool = True) -> Ingested:
    """Links, graph and report from an extraction table ``(page, reason, hrefs, line)``."""
    if materialize:
        extracted, _ = written(extracted, "extracted")
    # Raw in-scope anchors bound the links from above; one pass over that
    # column lets the graph's first shuffles be sized for them.
    hint = extracted.agg(F.coalesce(F.sum(F.size("hrefs")), F.lit(0))).first()[0]
    links = link_rows(extracted, link_pattern, decode)
    ok = extracted.where(F.col("reason") == OK)
    graph = Graph(edges=links.select(F.col("page").alias("src"), F.col("target").alias("dst")),
                  pages=ok.select(F.col("page").alias("id")),
                  records=ok.select("page"), links_hint=hint)
    return Ingested(extracted, links, graph)


def ingest_lines(lines: DataFrame, mode: str = "strict", container=CONTAINER,
                 link_pattern: str = LINK_TARGET_PATTERN, decode: bool = True,
                 line_col: str = "value", materialize: bool = True,
                 keep_rejected_lines: bool = True) -> Ingested:
    """Text lines ``name:html`` (S1) → records, links and graph.

    ``keep_rejected_lines=False`` keeps only the page name and reason of
    rejected records, so a dump with many rejects is not copied into the
    checkpoint; the counts of :meth:`Ingested.report` are the same.
    """
    split = split_records(lines, line_col)
    if not keep_rejected_lines:
        split = split.drop("line")
    return from_extracted(extract_links(split, mode, container), link_pattern, decode, materialize)


def ingest_pages(pages: DataFrame, mode: str = "lenient", container=NAV_CONTAINER,
                 link_pattern: str = NAV_LINK_PATTERN, decode: bool = True,
                 materialize: bool = True) -> Ingested:
    """A page table ``(page, html)`` → links and graph. There is no line to
    split, but names follow the same rule as in a dump: rows with a null, empty
    or tilde-holding name are rejected (``bad_name``)."""
    named = pages.select(F.col("page").cast("string").alias("page"), "html",
                         F.when(~name_ok("page"), F.lit(BAD_NAME)).alias("reason"))
    extracted = extract_links(named, mode, container)
    return from_extracted(extracted, link_pattern, decode, materialize)


def run_dump(spark: SparkSession, path: str, alpha: float = ALPHA,
             iterations: int = ITERATIONS, k: int = TOP_K,
             split: int = DEFAULT_SPLIT) -> DataFrame:
    """The reference's whole program on a page dump: ingest, rank, top-k."""
    ing = ingest_lines(read_lines(spark, path))
    ranks = rank_nodes(ing.graph, alpha=alpha, iterations=iterations, split=split)
    return top_k(ranks, k)
