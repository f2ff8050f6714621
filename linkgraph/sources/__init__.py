"""Scans and sinks.

* ``read_lines``        S1  page dump as text lines (``.bz2``/``.gz`` split and decoded by Spark)
* ``read_page_table``       page table ``(page, html)`` from parquet or any DataFrame
* ``write_graph``       S2  edge snapshot ``(src, dst, mult)`` + vertex table, parquet, committed by a manifest (:mod:`.manifest`)
* ``read_graph``        S3  the last committed snapshot back as a :class:`~linkgraph.operators.graph.Graph`
* ``write_rank_snapshot`` S4  one round of ranks, parquet, ``iter=<i>`` sub-folder
* ``write_ranked_text`` S5  ``name rank`` text lines, one file per partition
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import ranked_line
from . import manifest


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column ``value``. Splittable codecs (bz2) are split
    by Spark across tasks, so a single large dump still scans in parallel."""
    return spark.read.text(path)


def read_page_table(spark: SparkSession, path: str, page_col: str = "page",
                    html_col: str = "html") -> DataFrame:
    """A table source of pages: ``(page, html)`` without the line format."""
    df = spark.read.parquet(path)
    return df.select(F.col(page_col).cast("string").alias("page"),
                     F.col(html_col).alias("html"))


def _files(spark: SparkSession, path: str) -> list[list]:
    """``[name, bytes]`` of the data files of a written table, sorted."""
    found = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1), "length").collect()
    return sorted([r[0], r[1]] for r in found)


def write_graph(graph, path: str, mode: str = "overwrite", keep: int = 2) -> int:
    """The merged adjacency as a compacted edge table and a vertex table.

    Edges are written as ``(src, dst, mult)`` sorted by ``(src, dst)``: the same
    information as per-page link lists, without gathering any one page's links
    into a single row (a hub page may hold a large share of all links). The
    vertex table ``(id, out_degree, n_targets, n_sources, dangling, is_page)`` keeps pages
    without links.

    Both tables go into a version folder of their own; the snapshot becomes
    this version when its manifest (counts, among them A2's record count,
    schemas, files) is renamed into place. A write that dies before leaves the
    last snapshot as it was. Returns the version's number. The last ``keep``
    versions stay, so that who still reads the one before can go on; older ones
    and what died writers left are removed. ``mode``: ``overwrite``, or
    ``error`` if there must be no snapshot yet.
    """
    from ..operators.graph import edge_pairs, node_table
    from ..session import sized_shuffles

    if mode not in ("overwrite", "error"):
        raise ValueError("mode must be 'overwrite' or 'error'")
    if keep < 1:
        raise ValueError("keep must be at least 1")
    spark = graph.edges.sparkSession
    before = manifest.numbers(spark, path)
    if before and mode == "error":
        raise FileExistsError(f"there is a graph snapshot in {path}")
    number = before[-1] + 1 if before else 1
    folder = f"version-{number:010d}-{uuid.uuid4().hex[:8]}"
    edges, nodes = f"{path}/{folder}/edges", f"{path}/{folder}/nodes"
    # A global sort range-partitions on (src, dst): the files stay clustered by
    # source, and a source with a huge share of links spans several tasks.
    with sized_shuffles(spark, graph.links_hint or 0):
        edge_pairs(graph).orderBy("src", "dst").write.parquet(edges)
    # The vertices come from the merged links just written, not from another merge.
    pairs = spark.read.parquet(edges)
    n_edges = pairs.count()
    with sized_shuffles(spark, n_edges):
        node_table(graph, pairs).write.parquet(nodes)
    vertices = spark.read.parquet(nodes)
    known = graph.record_count is not None or graph.records is not None
    manifest.commit(spark, path, number, {
        "folder": folder, "records": graph.n_records() if known else None, "edges": n_edges, "nodes": vertices.count(),
        "schemas": {"edges": pairs.schema.jsonValue(), "nodes": vertices.schema.jsonValue()},
        "files": {"edges": _files(spark, edges), "nodes": _files(spark, nodes)}})
    _keep_versions(spark, path, keep)
    return number


def _keep_versions(spark: SparkSession, path: str, keep: int) -> None:
    from ..session import remove_path

    held = manifest.numbers(spark, path)
    for number in held[:-keep]:
        remove_path(spark, manifest.file_of(path, number))
    named = {manifest.read(spark, path, n)["folder"] for n in held[-keep:]}
    for name in manifest.listing(spark, path):
        # Folders of later numbers may be another writer's, at work.
        if name.startswith("version-") and name not in named and int(name.split("-")[1]) <= held[-1]:
            remove_path(spark, f"{path}/{name}")


def read_graph(spark: SparkSession, path: str, version: int | None = None, check: bool = True):
    """S3: the last graph that :func:`write_graph` committed to ``path``, or the
    one of a given number, with its record count.

    ``check`` compares the files there are with those the manifest lists, so
    that a lost or cut file is an error here, not a smaller graph.
    """
    from ..operators.graph import Graph

    found = manifest.read(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no graph snapshot was committed to {path}")
    at = f"{path}/{found['folder']}"
    for name, files in found["files"].items():
        if check and _files(spark, f"{at}/{name}") != files:
            raise OSError(f"the {name} of {at} are not the files that its manifest lists")
    tables = {name: spark.read.schema(StructType.fromJson(schema)).parquet(f"{at}/{name}") for name, schema in found["schemas"].items()}
    # Merged links; their number sizes later shuffles.
    return Graph(edges=tables["edges"].select("src", "dst", "mult"), pages=tables["nodes"].where("is_page").select("id"),
                 links_hint=found["edges"], merged=True, record_count=found["records"])


def write_rank_snapshot(ranks: DataFrame, prefix: str, iteration: int,
                        mode: str = "overwrite") -> str:
    """One round of ranks under ``<prefix>/iter=<i>``."""
    out = f"{prefix}/iter={iteration}"
    if "id" not in ranks.columns:
        ranks = ranks.withColumnRenamed("name", "id")       # a top-k (name, rank)
    ranks.select("id", "rank").write.mode(mode).parquet(out)
    return out


def write_ranked_text(ranked: DataFrame, path: str, decimals: int | None = None,
                      mode: str = "overwrite") -> None:
    """``name rank`` lines, highest rank first (Java double text unless ``decimals``).

    A global sort range-partitions the rows, so the part files read in order
    make one ordered listing whether ``ranked`` is a top-k or a whole table;
    no single task has to hold it all.
    """
    if "name" not in ranked.columns:
        ranked = ranked.withColumnRenamed("id", "name")     # a whole rank table (id, rank)
    (ranked.orderBy(F.desc("rank"), F.asc("name"))
     .select(ranked_line("name", "rank", decimals).alias("value"))
     .write.mode(mode).text(path))
