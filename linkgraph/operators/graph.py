"""The directed multigraph as DataFrames.

Canonical form is an edge table: ``edges(src, dst)`` with one row per link
(repeats and self-links kept), or already compacted as ``(src, dst, mult)``.
``pages`` lists vertices known as pages, so a page without out-links still
exists. The vertex universe is pages ∪ link sources ∪ link targets.

Nothing here gathers one vertex's links into a single row: a hub may hold a
large share of all edges. Everything is a grouped count or sum, which Spark
pre-aggregates in each task before the exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Graph:
    edges: DataFrame
    pages: DataFrame | None = None     # (id); pages that exist even without links
    records: DataFrame | None = None   # (page); one row per accepted record, repeats kept
    links_hint: int | None = None      # upper bound on link rows, when known (sizes the first shuffles)
    merged: bool = False               # edges are (src, dst, mult) already, one row per (src, dst)
    record_count: int | None = None    # accepted records, where they are known but not kept (a snapshot)

    def n_records(self) -> int:
        """A2: the number of accepted records (same-named pages counted apart)."""
        if self.record_count is not None:
            return self.record_count
        if self.records is None:
            raise ValueError("this graph carries no record table")
        return self.records.count()


def edge_pairs(graph: Graph) -> DataFrame:
    """A1: links merged per ``(src, dst)`` with their multiplicity ``mult``
    (links with a missing end are not links and are left out)."""
    e = graph.edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if graph.merged:
        return e.select("src", "dst", F.col("mult").cast("bigint").alias("mult"))
    mult = F.sum("mult") if "mult" in e.columns else F.count(F.lit(1))
    return e.groupBy("src", "dst").agg(mult.cast("bigint").alias("mult"))


def out_degree(graph: Graph, pairs: DataFrame | None = None) -> DataFrame:
    """A3: ``(src, out_degree, n_targets)``: links with repeats, distinct targets."""
    p = edge_pairs(graph) if pairs is None else pairs
    return p.groupBy("src").agg(F.sum("mult").alias("out_degree"),
                                F.count(F.lit(1)).alias("n_targets"))


def node_table(graph: Graph, pairs: DataFrame | None = None) -> DataFrame:
    """G3 + J4: every vertex once, ``(id, out_degree, n_targets, n_sources, dangling, is_page)``.

    ``is_page`` marks vertices that are pages (listed in ``pages``, or the
    source of a link) as opposed to vertices known only as link targets.
    ``n_targets`` and ``n_sources`` count distinct neighbours. One exchange by
    id: each merged link gives a row to either end, and pages theirs. Pages
    without a name are no vertices.
    """
    p = edge_pairs(graph) if pairs is None else pairs
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.col("mult").alias("out"), one.alias("to"), zero.alias("from"), F.lit(True).alias("page")),
        F.struct(F.col("dst").alias("id"), zero.alias("out"), zero.alias("to"), one.alias("from"), F.lit(False).alias("page")))
    parts = p.select(F.explode(ends).alias("e")).select("e.*")
    if graph.pages is not None:
        parts = parts.unionByName(graph.pages.where("id is not null").select(
            F.col("id"), zero.alias("out"), zero.alias("to"), zero.alias("from"), F.lit(True).alias("page")))
    nodes = parts.groupBy("id").agg(
        F.sum("out").alias("out_degree"), F.sum("to").alias("n_targets"), F.sum("from").alias("n_sources"),
        F.max("page").alias("is_page"))
    return nodes.select("id", "out_degree", "n_targets", "n_sources",
                        (F.col("out_degree") == 0).alias("dangling"), "is_page")


def _vertices(graph: Graph) -> DataFrame:
    """``(id, has_out)`` of every vertex, from one read of the links and one exchange."""
    links = graph.edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    ends = F.array(F.struct(F.col("src").alias("id"), F.lit(True).alias("has_out")),
                   F.struct(F.col("dst").alias("id"), F.lit(False).alias("has_out")))
    parts = links.select(F.explode(ends).alias("e")).select("e.id", "e.has_out")
    if graph.pages is not None:
        parts = parts.unionByName(graph.pages.where("id is not null").select("id", F.lit(False).alias("has_out")))
    return parts.groupBy("id").agg(F.max("has_out").alias("has_out"))


def node_universe(graph: Graph) -> DataFrame:
    """``(id)`` of every vertex: pages ∪ sources ∪ targets."""
    return _vertices(graph).select("id")


def dangling_nodes(graph: Graph) -> DataFrame:
    """``(id)`` of vertices without out-links."""
    return _vertices(graph).where(~F.col("has_out")).select("id")
