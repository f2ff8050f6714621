"""Damped rank propagation with dangling-mass redistribution.

Standard form (α = 0.15, d(u) = out-degree with repeats, V = every vertex,
N = |V|, r₀ = 1/N):

    δᵢ      = Σ rᵢ(u) over u with d(u) = 0
    rᵢ₊₁(v) = α/N + (1−α)·(δᵢ/N + Σ_{u→v} rᵢ(u)·mult(u,v)/d(u))

Ranks total 1 in every round. The parity step is one round with N = accepted
records, r₀ = 1/N on pages only and δ = 0.

Preparation, once (:func:`prepare_graph`): repeated links are merged, every
vertex gets a unique 64-bit id ``vid``, and the weighted edges are written as
rows ``(src_vid, bucket, w, dst_vids)``, the targets of one source that share a
weight (a bounded number per row), in a table bucketed by ``(src_vid, bucket)``
(bucket count from the edge count) and cached with that layout. Names never
travel through the rounds; they are joined back once at the end.

Plan per round (edges are never shuffled again):

1. ranks of vertices with out-links, one row per (vertex, bucket), are
   shuffled to the bucketed edge table's layout and joined to it
   (shuffled hash join, ranks as the build side; never broadcast, as ranks
   grow with the graph);
2. contributions ``w·rank`` are summed per target inside each task (exactly, see below; by
   sorting a bounded number of links at a time, :mod:`.links`), then one
   exchange by vertex id brings them together with every vertex's own row
   (so vertices without in-links stay, at 0) — a co-group, without a join;
3. the new ranks are checkpointed to the shared checkpoint folder, which cuts
   the lineage and lets a lost executor's work be recomputed from the last
   round only; one small aggregate over that checkpoint gives the round's
   metrics, including the next δ.

Sums are exact: a share of rank is cut into two whole numbers (units of 2^-60
and of 2^-86 of the total), which are summed, so neither the order in which rows
arrive nor the number of partitions changes a bit of any rank.

Skew: a vertex with very many distinct targets is split into
``ceil(targets / split)`` buckets by a hash of the target, so its edges spread
over many tasks; its rank row is repeated once per bucket. A vertex with very
many in-links is pre-aggregated in every task before the exchange.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import ALPHA, ITERATIONS
from ..session import checkpoint_root, remove_path, scratch_path, sized_shuffles, written
from ..sources import manifest, write_rank_snapshot
from . import blocks as B
from .graph import Graph, edge_pairs, node_table
from .links import BLOCK_SCHEMA, LIST_SCHEMA, blocks_of_rows, blocks_of_sums, link_lists, links_of_lists, rows_of_blocks
from .numbering import PLACE, numbered, with_numbers
from .rounds import ROUND_SCHEMA, Checkpoints, RoundLog

# Most distinct targets one (source, bucket) group holds before the source is split.
DEFAULT_SPLIT = 1 << 16
# Bucket sizing of the edge table, in compacted edges: no bucket above the
# first; small graphs get at most one bucket per core, none below the second.
EDGES_PER_BUCKET = 8 << 20
MIN_EDGES_PER_BUCKET = 256 << 10
# A vertex with more than 1/HOT_VERTICES of all merged links at either end (and
# more than MIN_HOT_LINKS) is looked up apart when links get their vertex ids.
HOT_VERTICES = 10_000
MIN_HOT_LINKS = 1 << 12
# Blocks of names and links while a graph is prepared: links of each, and most blocks.
LINKS_PER_BLOCK, MIN_LINKS_PER_BLOCK, MAX_LINK_BLOCKS = 1 << 20, 1 << 16, 1 << 16
# Vertex numbers of a block: blocks per core, and their least and largest size.
BLOCKS_PER_CORE, MIN_BLOCK, MAX_BLOCK = 32, 1 << 10, 1 << 16
# Rows per bucket of the name table that snapshots are joined with.
NAMES_PER_BUCKET = 2 << 20
# Binary places of the two whole numbers that a share of rank is cut into. Sums
# of up to 8 in all, of up to 2^37 shares each, fit 64 bits.
UNIT_BITS, REST_BITS = 60, 26


def bucket_count(n_pairs: int, parallelism: int) -> int:
    """Buckets for ``n_pairs`` compacted edges: large graphs get ~8 M edges per
    bucket; smaller ones spread over the cores without making tiny buckets."""
    by_size = math.ceil(n_pairs / EDGES_PER_BUCKET)
    by_cores = min(max(parallelism, 1), math.ceil(n_pairs / MIN_EDGES_PER_BUCKET))
    return max(1, by_size, by_cores)


@dataclass
class PreparedGraph:
    """Edges weighted and laid out once; vertices with their attributes."""

    wedges: DataFrame      # (src_vid, bucket, w, dst_vids) bucketed by (src_vid, bucket)
    nodes: DataFrame       # (id, out_degree, n_targets, n_sources, dangling, is_page, nb, vid), written
    n_nodes: int
    table: str
    partitions: int
    n_pairs: int = 0       # compacted edges
    paths: tuple[str, ...] = ()    # what this preparation wrote
    state: str | None = None       # folder that keeps it for later sessions
    _names: tuple[DataFrame, str, str] | None = None   # bucketed name table, its catalog name and path

    def names(self) -> DataFrame:
        """``(vid, id, is_page)`` written once, bucketed by ``vid``: names that
        many rounds are joined with stay where they are."""
        if self._names is None:
            spark = self.wedges.sparkSession
            parts = max(1, math.ceil(self.n_nodes / NAMES_PER_BUCKET),
                        min(spark.sparkContext.defaultParallelism, math.ceil(self.n_nodes / MIN_EDGES_PER_BUCKET)))
            table, path = f"linkgraph_names_{uuid.uuid4().hex[:12]}", scratch_path(spark, "names")
            (self.nodes.select("vid", "id", "is_page").repartition(parts, "vid")
             .write.bucketBy(parts, "vid").option("path", path).saveAsTable(table))
            self._names = (spark.table(table), table, path)
        return self._names[0]

    def named_in_place(self, ranks: DataFrame) -> DataFrame:
        """``(id, rank, is_page)``, for every round's ranks: numbers move, names do not."""
        return (self.names().join(ranks.select("vid", "rank").hint("shuffle_hash"), "vid")
                .select("id", "rank", "is_page"))

    def named(self, ranks: DataFrame) -> DataFrame:
        """``(id, rank, is_page)``: vertex names joined back onto ranks by ``vid``."""
        return (ranks.select("vid", "rank")
                .join(self.nodes.select("vid", "id", "is_page"), "vid")
                .select("id", "rank", "is_page"))

    def release(self) -> None:
        """Drop the edge table's cache and catalog entry, and delete the edge,
        link and vertex tables that the preparation wrote, unless a state folder
        keeps them. Results must have been materialized before (:func:`finish` does)."""
        spark = self.wedges.sparkSession
        self.wedges.unpersist()
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self._names:
            spark.sql(f"DROP TABLE IF EXISTS {self._names[1]}")
            remove_path(spark, self._names[2])
            self._names = None
        for path in () if self.state else self.paths:
            remove_path(spark, path)


def _with_vids(links: DataFrame, end: str, other: str, nodes: DataFrame, hot: DataFrame,
               columns: list[Column]) -> DataFrame:
    """``links`` with the columns ``columns`` of the vertex at ``end``.

    A vertex with a large share of the links would send them all to one task of
    a join by name. The few ``hot`` vertices (a bounded table, so it is
    broadcast) are looked up first; their links then pass through the join under
    a salt of their other end, spread over all tasks, and match nothing there.
    """
    # One letter tells names from salts, so that a salt is never a vertex's name.
    info = nodes.select(F.concat(F.lit("v"), "id").alias("__key"), F.struct(*columns).alias("__cold"))
    known = hot.select(F.col("id").alias(end), F.struct(*columns).alias("__hot"))
    looked = links.join(F.broadcast(known), end, "left")
    salt = F.concat(F.lit("h"), F.xxhash64(other).cast("string"))
    keyed = looked.withColumn("__key", F.when(F.col("__hot").isNotNull(), salt).otherwise(F.concat(F.lit("v"), end)))
    joined = keyed.join(info.hint("shuffle_hash"), "__key", "left")
    found = F.coalesce("__hot", "__cold")
    return joined.withColumn("__found", found).select(*links.columns, "__found.*")


def name_key(name) -> Column:
    """The 64-bit key that names are numbered and links looked up by."""
    return F.xxhash64(name)


def link_blocks(n_links: int, parallelism: int) -> int:
    """Blocks of names and links: about ``LINKS_PER_BLOCK`` links each, fewer where that leaves cores idle."""
    by_cores = min(4 * max(parallelism, 1), math.ceil(n_links / MIN_LINKS_PER_BLOCK))
    return max(1, min(MAX_LINK_BLOCKS, max(math.ceil(n_links / LINKS_PER_BLOCK), by_cores)))


def _by_blocks(graph: Graph, split: int, path: str) -> tuple[DataFrame, DataFrame, list[str], list[str]] | None:
    """Vertices, written to ``path``; weighted target lists; and the paths of the written links
    and vertices, and of what only leads to the lists. ``None`` if two names share a key, or names are not strings.

    See :mod:`.blocks`: names move once per task and block, links twice, as numbers.
    """
    spark = graph.edges.sparkSession
    links = graph.edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    pages = None if graph.pages is None else graph.pages.select("id").where("id is not null")
    if {links.schema[c].dataType for c in ("src", "dst")} | ({pages.schema["id"].dataType} if pages is not None else set()) != {StringType()}:
        return None
    mult = [F.coalesce(F.col("mult").cast("bigint"), F.lit(0).cast("bigint")).alias("mult")] if "mult" in links.columns else []
    keyed = links.select("src", "dst", name_key("src").alias("src_key"), name_key("dst").alias("dst_key"), *mult).mapInArrow(B.keyed(), B.KEYED)
    if pages is not None:
        keyed = keyed.unionByName(pages.select("id", name_key("id").alias("key")).mapInArrow(B.keyed(listed=True), B.KEYED))
    # Written rather than cached: read twice below, and survives a lost executor.
    with sized_shuffles(spark, graph.links_hint or 0):
        keyed, links_path = written(keyed, "links")
    links, names = keyed.where("a is not null").select("a", "b", "c"), keyed.where("keys is not null").drop("a", "b", "c")
    n_links = links.agg(F.coalesce(F.sum(F.octet_length("a")), F.lit(0))).first()[0] // 8
    blocks = link_blocks(n_links, spark.sparkContext.defaultParallelism)
    names, names_path = written(names.mapInArrow(B.names_by_block(blocks), B.NAMES_MOVING).repartitionById(blocks, "block")
                                .mapInArrow(B.names_of_block, B.NAMES), "names")

    # To the driver: a row per block.
    counted = names.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("clash").alias("clash")).collect()
    if any(r["clash"] for r in counted):
        for path in (links_path, names_path):
            remove_path(spark, path)
        return None
    sizes = np.zeros(blocks, np.int64)
    for r in counted:
        sizes[r["block"]] = r["n"]
    offsets = np.cumsum(sizes) - sizes
    # At most 2 * HOT_VERTICES vertices reach this share of all links.
    heavy = max(n_links // HOT_VERTICES, MIN_HOT_LINKS)
    top = names.where((F.col("outs") > heavy) | (F.col("ins") > heavy)).select("key", "block", "place").collect()
    keys, vids = np.array([r["key"] for r in top], np.int64).view(np.uint64), np.array([offsets[r["block"]] + r["place"] for r in top], np.int64)
    hot = B.Hot(keys[np.argsort(keys)], vids[np.argsort(keys)])

    block_keys = names.select("key").mapInArrow(B.keys_of_names(blocks), B.LINKS_MOVING)
    by_source = (links.mapInArrow(B.links_by_target(blocks, hot), B.LINKS_MOVING).unionByName(block_keys)
                 .repartitionById(blocks, "block").mapInArrow(B.links_by_source(blocks, offsets, hot), B.LINKS_MOVING))
    lists = by_source.unionByName(block_keys).repartitionById(blocks, "block").mapInArrow(B.lists_of_sources(offsets, hot), B.MERGED)
    merged, merged_path = written(lists, "merged")

    degrees = merged.groupBy("vid").agg(F.sum(F.col("mult") * F.col("n")).alias("out_degree"), F.sum("n").alias("n_targets"),
                                        F.sum("n_sources").alias("n_sources"))
    offset = F.get(F.from_json(F.lit(json.dumps(offsets.tolist())), "array<bigint>"), F.col("block"))
    none = F.lit(0).cast("bigint")
    nodes = (names.select((offset + F.col("place")).alias("vid"), "id", "listed").join(degrees, "vid", "left")
             .select("id", *(F.coalesce(c, none).alias(c) for c in ("out_degree", "n_targets", "n_sources")), "listed", "vid")
             .select("id", "out_degree", "n_targets", "n_sources", (F.col("out_degree") == 0).alias("dangling"),
                     (F.col("listed") | (F.col("n_targets") > 0)).alias("is_page"), _buckets(split).alias("nb"), "vid"))
    with sized_shuffles(spark, int(sizes.sum())):
        nodes, path = written(nodes, "nodes", path)
    known = {r["vid"]: (r["out_degree"], r["n_targets"])
             for r in nodes.where(F.col("vid").isin(hot.vids.tolist())).select("vid", "out_degree", "n_targets").collect()} if len(top) else {}
    wedges = merged.where("n > 0").drop("n_sources").mapInArrow(B.lists_by_bucket(split, known), LIST_SCHEMA)
    return nodes, wedges, [links_path, path], [names_path, merged_path]


def _buckets(split: int) -> Column:
    return F.when(F.col("n_targets") > 0, F.ceil(F.col("n_targets") / F.lit(split))).otherwise(F.lit(0)).cast("bigint")


def _by_names(graph: Graph, split: int, path: str) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """The same as :func:`_by_blocks`, by joins on the names themselves, whatever their keys and type."""
    spark = graph.edges.sparkSession
    with sized_shuffles(spark, graph.links_hint or 0):
        pairs, pairs_path = written(edge_pairs(graph), "pairs")
    n_pairs = pairs.count()
    with sized_shuffles(spark, n_pairs):
        nodes, path = numbered(node_table(graph, pairs).withColumn("nb", _buckets(split)), "vid", path=path)
    # At most 2 * HOT_VERTICES vertices reach this share of all links.
    heavy = max(n_pairs // HOT_VERTICES, MIN_HOT_LINKS)
    hot = nodes.where((F.col("n_targets") > heavy) | (F.col("n_sources") > heavy))
    wedges = pairs.select("src", "dst", "mult")
    # Targets first: links then lie by their source, so they move on to the buckets as lists.
    wedges = _with_vids(wedges, "dst", "src", nodes, hot, [F.col("vid").alias("dst_vid")]).drop("dst")
    wedges = _with_vids(wedges, "src", "dst_vid", nodes.where(F.col("nb") > 0), hot,
                        [F.col("vid").alias("src_vid"), F.col("out_degree"), F.col("nb")])
    wedges = wedges.select("src_vid",
                           F.pmod(F.xxhash64("dst_vid"), F.col("nb")).cast("bigint").alias("bucket"),
                           "dst_vid",
                           (F.col("mult") / F.col("out_degree")).alias("w")).mapInArrow(link_lists, LIST_SCHEMA)
    return nodes, wedges, [pairs_path, path], []


def prepared(spark, state: str) -> bool:
    """Whether ``state`` holds a whole preparation."""
    return bool(manifest.numbers(spark, f"{state}/graph"))


def reopen(spark, state: str, cache_edges: bool = True) -> PreparedGraph:
    """The preparation that :func:`prepare_graph` committed to ``state``, in this or an earlier session."""
    found = manifest.read(spark, f"{state}/graph")
    if found is None:
        raise FileNotFoundError(f"no prepared graph was committed to {state}")
    if found.get("links") != LIST_SCHEMA:
        raise ValueError(f"the graph in {state} was prepared with another layout of its links; prepare it again in a new folder")
    checkpoint_root(spark)
    at = {kind: f"{state}/graph/{found['folder']}/{kind}" for kind in ("nodes", "wedges")}
    nodes = spark.read.schema(found["node_schema"]).parquet(at["nodes"])
    if PLACE in nodes.columns:
        nodes = with_numbers(nodes, "vid")
    table, parts = f"linkgraph_wedges_{uuid.uuid4().hex[:12]}", found["partitions"]
    spark.sql(f"CREATE TABLE {table} ({LIST_SCHEMA}) USING parquet "
              f"CLUSTERED BY (src_vid, bucket) INTO {parts} BUCKETS LOCATION '{at['wedges']}'")
    edges = spark.table(table)
    if cache_edges:
        edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
    return PreparedGraph(edges, nodes, found["n_nodes"], table, parts, found["n_pairs"], (), state)


def prepare_graph(graph: Graph, split: int = DEFAULT_SPLIT,
                  partitions: int | None = None, cache_edges: bool = True, state: str | None = None) -> PreparedGraph:
    """Compact, number, weight and lay out the edges once for all rounds.

    * the links written once as keys, with the names that they hold;
    * vertices with degree, bucket count ``nb`` and a dense number ``vid``
      (0 … N-1), written (which fixes the numbers for good);
    * links numbered at both ends, repeats merged (:func:`_by_blocks`);
    * ``wedges(src_vid, bucket, w = mult/d(src), dst_vids)`` written as a table
      bucketed by ``(src_vid, bucket)`` into the checkpoint folder, so each
      round joins against it without moving an edge. The bucket count is
      ``partitions``, or derived from the edge count (:func:`bucket_count`),
      not from the session's shuffle partitions, which suit no single size.
      With ``cache_edges`` the table is also cached (memory, then executors'
      local disks) on first use, keeping its bucket layout; a lost block is
      read again from the table.

    With ``state``, a folder for one graph, the preparation is kept there for
    later sessions and committed as a whole; if it is there already, it is
    opened and ``graph`` is not read.
    """
    if split < 1:
        raise ValueError("split must be at least 1")
    spark = graph.edges.sparkSession
    if state and prepared(spark, state):
        return reopen(spark, state, cache_edges)
    checkpoint_root(spark)
    folder = f"prepared-{uuid.uuid4().hex[:8]}"

    def place(kind: str) -> str:
        return f"{state}/graph/{folder}/{kind}" if state else scratch_path(spark, kind)

    nodes, wedges, paths, passing = _by_blocks(graph, split, place("nodes")) or _by_names(graph, split, place("nodes"))
    sizes = nodes.agg(F.count(F.lit(1)).alias("n"),
                      F.coalesce(F.sum("n_targets"), F.lit(0)).alias("pairs")).first()
    n = sizes["n"]
    if partitions:
        parts = int(partitions)
    else:
        parts = bucket_count(sizes["pairs"], spark.sparkContext.defaultParallelism)
    table = f"linkgraph_wedges_{uuid.uuid4().hex[:12]}"
    paths.append(place("wedges"))
    with sized_shuffles(spark, sizes["pairs"]):
        (wedges.repartition(parts, "src_vid", "bucket")
         .write.bucketBy(parts, "src_vid", "bucket")
         .option("path", paths[-1])
         .saveAsTable(table))
    for path in passing:
        remove_path(spark, path)
    if state:
        manifest.commit(spark, f"{state}/graph", 1, {
            "folder": folder, "partitions": parts, "n_nodes": n, "n_pairs": sizes["pairs"], "split": split,
            "links": LIST_SCHEMA,
            "node_schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(paths[-2]).schema)})
        for path in paths[:-2]:     # the links are not needed any more
            remove_path(spark, path)
    edges = spark.table(table)
    if cache_edges:
        edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
    return PreparedGraph(edges, nodes, n, table, parts, sizes["pairs"], tuple(paths), state)


def initial_ranks(prep: PreparedGraph, n: float, pages_only: bool = False) -> DataFrame:
    """``(vid, nb, rank, prev)`` with r₀ = 1/N for every vertex, or
    (parity) for pages only and 0 elsewhere."""
    r0 = F.lit(1.0 / n) if n else F.lit(0.0)
    rank = F.when(F.col("is_page"), r0).otherwise(F.lit(0.0)) if pages_only else r0
    return prep.nodes.select("vid", "nb", rank.alias("rank"), rank.alias("prev"))


def unit_bits(mass: float) -> int:
    """Binary places at which whole-number sums of up to ``mass`` fit 64 bits."""
    return UNIT_BITS - max(0, math.ceil(math.log2(mass))) if mass > 0 else UNIT_BITS


def _units(share: Column, bits: int) -> tuple[Column, Column]:
    """``share`` (not negative) in units of 2^-bits, and what is left in units of 2^-(bits + REST_BITS).
    Scaling by powers of two and cutting are exact, so both depend on the share alone."""
    scaled = share * F.lit(2.0 ** bits)
    units = F.floor(scaled)
    return units, F.floor((scaled - units) * F.lit(2.0 ** REST_BITS))


def _of_units(units: Column, rest: Column, bits: int) -> Column:
    return (units + rest / F.lit(2.0 ** REST_BITS)) / F.lit(2.0 ** bits)


def exact_sum(share: Column, bits: int = UNIT_BITS) -> Column:
    """A sum of doubles that does not depend on their order; 0 without rows."""
    units, rest = _units(share, bits)
    none = F.lit(0).cast("bigint")
    return _of_units(F.coalesce(F.sum(units), none), F.coalesce(F.sum(rest), none), bits)


def dangling_mass(ranks: DataFrame, bits: int = UNIT_BITS) -> DataFrame:
    """A5: one row ``dangling_mass``: total rank held by vertices without out-links."""
    return ranks.where(F.col("nb") == 0).agg(exact_sum(F.col("rank"), bits).alias("dangling_mass"))


def _rank_rows_by_bucket(ranks: DataFrame, *more: str) -> DataFrame:
    return (ranks.where(F.col("nb") > 0)
            .select(F.col("vid").alias("src_vid"),
                    F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1)).alias("bucket"),
                    "rank", *more))


def _carried(prep: PreparedGraph, ranks: DataFrame, *more: str) -> DataFrame:
    """``(src_vid, dst_vids, c)``: the rank ``c`` carried along each of the
    compacted edges to ``dst_vids``, with the columns ``more`` of the rank rows."""
    rx = _rank_rows_by_bucket(ranks, *more)
    return (prep.wedges.join(rx.hint("shuffle_hash"), ["src_vid", "bucket"])
            .select("src_vid", "dst_vids", (F.col("w") * F.col("rank")).alias("c"), *more))


def block_size(n_nodes: int, parallelism: int) -> int:
    """Neighbouring vertex numbers that move together: enough blocks for all cores, none too small or large."""
    return max(MIN_BLOCK, min(MAX_BLOCK, math.ceil(n_nodes / (BLOCKS_PER_CORE * max(parallelism, 1)))))


def _moving(prep: PreparedGraph, ranks: DataFrame, bits: int, own: DataFrame, size: int) -> DataFrame:
    """Rows of ``BLOCK_SCHEMA``: the shares of ``ranks``, summed per task, and the rows ``own``."""
    units, rest = _units(F.col("c"), bits)
    shares = (_carried(prep, ranks).select("dst_vids", units.alias("u"), rest.alias("f"))
              .mapInArrow(blocks_of_sums(size), BLOCK_SCHEMA))
    return shares.unionByName(own.mapInArrow(blocks_of_rows(size), BLOCK_SCHEMA))


def _met(prep: PreparedGraph, ranks: DataFrame, bits: int, own: DataFrame) -> DataFrame:
    """The rows ``own``, ``(vid, u, f, ...)``, with the shares of ``ranks`` that
    reach the vertex added to ``u`` and ``f``.

    What meets at a vertex moves by blocks of neighbouring vertex numbers: a
    value for all shares that a task has for a block, not a row per share.
    """
    size = block_size(prep.n_nodes, prep.wedges.sparkSession.sparkContext.defaultParallelism)
    more = [(f.name, "<f8" if f.dataType.simpleString() == "double" else "<i8") for f in own.schema.fields[3:]]
    return (_moving(prep, ranks, bits, own, size).repartition("block")
            .mapInArrow(rows_of_blocks(size, more), own.schema))


def contributions(prep: PreparedGraph, ranks: DataFrame) -> DataFrame:
    """``(src, dst, contribution)``: rank carried along each compacted
    edge, with vertex names (a diagnostic view; the rounds never name vertices).
    A source's name comes along with its rank, so that edges move once, to their
    targets' names."""
    names = prep.nodes.select("vid", "id")
    named = ranks.join(names.withColumnRenamed("id", "src"), "vid")
    return (_carried(prep, named, "src")
            .select("src", "c", "dst_vids").mapInArrow(links_of_lists, "src string, c double, dst_vid bigint")
            .join(names.select(F.col("vid").alias("dst_vid"), F.col("id").alias("dst")), "dst_vid")
            .select("src", "dst", F.col("c").alias("contribution")))


def contribution_sums(prep: PreparedGraph, ranks: DataFrame, bits: int = UNIT_BITS) -> DataFrame:
    """``(vid, contrib_sum, nb, prev)`` for every vertex: the rank
    reaching it (0 without in-links) next to its bucket count and previous rank.
    ``bits``: :func:`unit_bits` of the ranks' total."""
    none = F.lit(0).cast("bigint")
    own = ranks.select("vid", none.alias("u"), none.alias("f"), "nb", F.col("rank").alias("prev"))
    return (_met(prep, ranks, bits, own)
            .select("vid", _of_units(F.col("u"), F.col("f"), bits).alias("contrib_sum"), "nb", "prev"))


def rank_step(prep: PreparedGraph, ranks: DataFrame, n: float, alpha: float = ALPHA,
              delta: float | None = None, bits: int = UNIT_BITS) -> DataFrame:
    """One round, ``(vid, nb, rank, prev)``. ``delta=None`` takes δ from
    ``ranks`` as a scalar subquery; a number fixes it (the loop passes the
    measured value; the parity step passes 0). Lazy: nothing runs here."""
    d = dangling_mass(ranks, bits).scalar() if delta is None else F.lit(float(delta))
    sums = contribution_sums(prep, ranks, bits)
    new = (F.lit(alpha / n) + F.lit(1.0 - alpha) * (d / F.lit(float(n)) + F.col("contrib_sum"))) \
        if n else F.lit(0.0)
    return sums.select("vid", "nb", new.alias("rank"), "prev")


# A round in which only changed vertices send also keeps what each vertex has
# sent so far and the sum that has reached it, as whole numbers.
ACTIVE_SCHEMA = f"{ROUND_SCHEMA}, sent double, u bigint, f bigint"


def active_start(prep: PreparedGraph, n: float) -> DataFrame:
    """Round 0 of the active set: nothing sent, nothing received."""
    none = F.lit(0).cast("bigint")
    return initial_ranks(prep, n).select("vid", "nb", "rank", "prev", F.lit(0.0).alias("sent"), none.alias("u"), none.alias("f"))


def sends(n: float, bound: float) -> Column:
    """Whether a vertex's rank is off what it has sent by more than its part of
    ``bound``: the rank itself or 1/N, so the parts of all vertices total 2 * ``bound``."""
    return (F.col("nb") > 0) & (F.abs(F.col("rank") - F.col("sent")) > F.lit(bound) * (F.col("rank") + F.lit(1.0 / n)))


def active_step(prep: PreparedGraph, ranks: DataFrame, n: float, alpha: float, delta: float, bound: float) -> DataFrame:
    """One round, ``(vid, nb, rank, prev, sent, u, f)``, in which a vertex
    sends the difference to what it has sent before, if it is large enough.

    Differences are summed exactly in the units of :func:`exact_sum`, on top of
    the sum that each vertex keeps, so no rounding builds up over the rounds.
    """
    sending = sends(n, bound)
    changes = ranks.where(sending).select("vid", "nb", (F.col("rank") - F.col("sent")).alias("rank"))
    own = ranks.select("vid", "u", "f", "nb", F.col("rank").alias("prev"),
                       F.when(sending, F.col("rank")).otherwise(F.col("sent")).alias("sent"))
    sums = _met(prep, changes, UNIT_BITS, own).select(
        "vid", "nb", "prev", "sent", (F.col("u") + F.shiftright("f", REST_BITS)).alias("u"),
        F.col("f").bitwiseAND(F.lit((1 << REST_BITS) - 1)).alias("f"))
    new = F.lit(alpha / n) + F.lit(1.0 - alpha) * (F.lit(delta / n) + _of_units(F.col("u"), F.col("f"), UNIT_BITS))
    return sums.select("vid", "nb", new.alias("rank"), "prev", "sent", "u", "f")


@dataclass
class RankRun:
    ranks: DataFrame                 # (vid, nb, rank, prev), checkpointed
    iterations: int
    trace: list[Row] = field(default_factory=list)


def _metrics(ranks: DataFrame, mass: float, **more: Column) -> dict:
    """One small aggregate over a round's N rows, never the edges; exact
    whatever tasks were retried. Its dangling mass is the next round's δ.
    ``mass`` bounds the ranks' total; ``more``: further aggregates."""
    bits = unit_bits(2 * mass)
    change = F.abs(F.col("rank") - F.col("prev"))
    return ranks.agg(exact_sum(F.col("rank"), bits).alias("rank_sum"),
                     exact_sum(F.when(F.col("nb") == 0, F.col("rank")), bits).alias("dangling_mass"),
                     F.coalesce(F.max(change), F.lit(0.0)).alias("max_change"),
                     exact_sum(change, bits).alias("l1_change"),
                     *(c.alias(name) for name, c in more.items())).first().asDict()


def run_rank(prep: PreparedGraph, alpha: float = ALPHA, iterations: int = ITERATIONS,
             n: str = "all", n_records: int | None = None, tol: float | None = None,
             trace: bool = False, snapshots: str | None = None, state: str | None = None, active: bool = False) -> RankRun:
    """The fixed-count loop, with per-round trace and optional early stop.

    ``n='all'``: N = |V|; ``n='records'``: N = accepted records (``n_records``),
    the reference's count. Only ``n='all'`` keeps the total at 1: with fewer
    records than vertices, every round adds mass, so ``records`` is meant for
    the single parity step (:func:`parity_step`). δ of each round is the dangling mass measured on the previous round's
    checkpoint. ``tol``: stop after the first round whose L1 change is below
    it. ``snapshots``: also write every round, named, as parquet under
    ``<snapshots>/iter=<i>`` (S4). At most two rounds are kept at a time.

    ``state``: the folder of a preparation that is kept (:func:`prepare_graph`
    with ``state``). Every round is then committed to a log in it, and a run
    that finds a log of the same parameters goes on after its last round, with
    the same ranks as an unbroken run. More iterations than logged go on too.

    ``active`` (with ``tol`` and ``n='all'``): a vertex sends only while its
    rank is off what it has sent by over a quarter of ``tol`` in proportion
    (:func:`sends`), and the run ends below half of ``tol``. All that is not
    sent then totals half of ``tol`` at most, so the ranks before the last round
    are ones that a full round would change by less than ``tol``: what the full
    loop ends with as well. The trace gains ``senders``, the vertices that send
    next, and ``sent_rows``, the rank rows that go to the edges for them.
    """
    if not 0.0 <= alpha <= 1.0:
        raise ValueError("alpha must lie in [0, 1]")
    if iterations < 0:
        raise ValueError("iterations must not be negative")
    if active and (tol is None or tol <= 0 or n != "all"):
        raise ValueError("active rounds need a tol above 0, and n='all'")
    if n == "all":
        size = float(prep.n_nodes)
    elif n == "records":
        if n_records is None:
            raise ValueError("n='records' needs n_records")
        size = float(n_records)
    else:
        raise ValueError("n must be 'all' or 'records'")
    spark = prep.wedges.sparkSession
    if state and prep.state != state:
        raise ValueError("a logged run needs the graph that this state folder keeps")
    log = RoundLog(spark, f"{state}/rounds", ACTIVE_SCHEMA if active else ROUND_SCHEMA) if state else Checkpoints()
    active = active and size > 0
    bound = min(tol, 1.0) / 4 if active else None      # of round 0, every vertex sends
    stop = tol / 2 if active else tol
    given = {"alpha": alpha, "size": size, "bound": bound}
    more = {} if not active else {
        "senders": F.count_if(sends(size, bound)),
        "sent_rows": F.coalesce(F.sum(F.when(sends(size, bound), F.col("nb"))), F.lit(0).cast("bigint"))}
    rows: list[dict] = []
    mass = prep.n_nodes / size if size else 0.0      # bounds the ranks' total

    def kept(i: int, ranks: DataFrame) -> DataFrame:
        ranks = log.keep(i, ranks)
        rows.append({"iteration": i, **_metrics(ranks, mass, **more)})
        if snapshots and i:
            write_rank_snapshot(prep.named_in_place(ranks), snapshots, i)
        log.commit(i, {**given, "rounds": rows}, spark)
        return ranks

    # Up to E' contributions plus N own rows reach the grouping by vertex
    # before the per-task sums shrink them; size that exchange for the bound.
    with sized_shuffles(spark, prep.n_pairs + prep.n_nodes):
        found = log.last()
        if found is None:
            done, ranks = 0, kept(0, active_start(prep, size) if active else initial_ranks(prep, size))
        else:
            done, was, ranks = found
            if {k: was.get(k) for k in given} != given or done > iterations:
                raise ValueError(f"the log in {state} is of another run: {done} rounds with {({k: was.get(k) for k in given})}")
            rows = was["rounds"]
        while done < iterations and not (stop is not None and done and rows[-1]["l1_change"] < stop):
            delta, total = rows[-1]["dangling_mass"], rows[-1]["rank_sum"]
            if size:
                mass = alpha * prep.n_nodes / size + (1 - alpha) * (prep.n_nodes * delta / size + total)
            ranks = kept(done + 1, active_step(prep, ranks, size, alpha, delta, bound) if active
                         else rank_step(prep, ranks, size, alpha, delta, unit_bits(total)))
            done += 1
    traced = [Row(**r) for r in rows[1:]]
    return RankRun(ranks, done, traced if trace or tol is not None else [])


def finish(prep: PreparedGraph, ranks: DataFrame, universe: str = "all") -> DataFrame:
    """``(id, rank)``: name the ranks and checkpoint the result, so it stays
    valid after the edge table's catalog entry is released."""
    if universe not in ("all", "pages"):
        raise ValueError("universe must be 'all' or 'pages'")
    out = prep.named(ranks)
    if universe == "pages":
        out = out.where("is_page")
    with sized_shuffles(prep.wedges.sparkSession, prep.n_nodes):
        return out.select("id", "rank").checkpoint()


def rank_nodes(graph: Graph, alpha: float = ALPHA, iterations: int = ITERATIONS,
               n: str = "all", universe: str = "all", tol: float | None = None,
               split: int = DEFAULT_SPLIT, partitions: int | None = None, active: bool = False) -> DataFrame:
    """The whole rank job: ``(id, rank)`` for every vertex after ``iterations`` rounds.

    ``universe='pages'`` keeps pages only in the result (ranks are computed on
    the whole graph either way).
    """
    prep = prepare_graph(graph, split=split, partitions=partitions)
    try:
        recs = graph.n_records() if n == "records" else None
        run = run_rank(prep, alpha, iterations, n=n, n_records=recs, tol=tol, active=active)
        return finish(prep, run.ranks, universe)
    finally:
        prep.release()


def rank_trace(graph: Graph, alpha: float = ALPHA, iterations: int = ITERATIONS,
               tol: float | None = None, split: int = DEFAULT_SPLIT,
               partitions: int | None = None) -> DataFrame:
    """``(iteration, rank_sum, dangling_mass, max_change, l1_change)`` per round."""
    prep = prepare_graph(graph, split=split, partitions=partitions)
    try:
        run = run_rank(prep, alpha, iterations, tol=tol, trace=True)
    finally:
        prep.release()
    spark = graph.edges.sparkSession
    schema = ("iteration bigint, rank_sum double, dangling_mass double, "
              "max_change double, l1_change double")
    return spark.createDataFrame(run.trace, schema)


def parity_step(graph: Graph, alpha: float = ALPHA, split: int = DEFAULT_SPLIT,
                partitions: int | None = None) -> DataFrame:
    """The reference's first round exactly: N = accepted records, r₀ = 1/N on
    pages only, δ = 0; one row per vertex. ``(id, rank)``."""
    prep = prepare_graph(graph, split=split, partitions=partitions)
    try:
        size = float(graph.n_records())
        r1 = rank_step(prep, initial_ranks(prep, size, pages_only=True), size, alpha, delta=0.0)
        with sized_shuffles(prep.wedges.sparkSession, prep.n_pairs + prep.n_nodes):
            r1 = r1.checkpoint()
        return finish(prep, r1)
    finally:
        prep.release()
