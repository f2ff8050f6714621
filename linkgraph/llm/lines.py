"""Line dedup by distinct-site spread, with DataFrame functions only.

A line that occurs on ``min_sites`` or more distinct sites is boilerplate: it
stays where it occurs first (smallest ``doc_id``, then position) and goes
everywhere else. Every distinct line gets a HyperLogLog sketch of its sites;
sketches are partial aggregates that merge, so a line of any frequency costs a
task one sketch. Lines whose estimate is within ``margin`` of the threshold get
an exact count of distinct sites; estimates beyond it are far outside the
sketch's error and decide by themselves.

Scale. Lines travel as two 64-bit hashes, not as text. The join of occurrences
with boilerplate lines can be split for hot lines; a document's own positions
are the only thing gathered, by document. The texts are shuffled once, to drop
their lines.

Cases: lines without a word are neither counted nor dropped; a null or empty
text stays as it is; a null site counts as no site; rows with equal ``doc_id``
and text are one document and share a result; a null ``doc_id`` comes last in
order; an empty table gives an empty result; extra columns are kept, one named
``removed_lines`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkgraph.llm.common import SPACES, saved

MIN_SITES = 8
MARGIN = 0.2
LG_K = 12


def _keys(docs: DataFrame) -> list:
    """Two hashes that identify a document by id and text."""
    return [F.xxhash64(F.lit(1), "doc_id", "text"), F.xxhash64(F.lit(2), "text", "doc_id")]


def occurrences(docs: DataFrame, site: str) -> DataFrame:
    """(k1, k2, doc_id, pos, l1, l2, site): a row per line that has a word."""
    k1, k2 = _keys(docs)
    lines = docs.select(k1.alias("k1"), k2.alias("k2"), F.col("doc_id").alias("doc_id"), F.col(site).alias("site"),
                        F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    worded = lines.where(F.btrim("line", F.lit(SPACES)) != "")
    return worded.select("k1", "k2", "doc_id", "pos", F.xxhash64(F.lit(1), "line").alias("l1"),
                         F.xxhash64("line", F.lit(2)).alias("l2"), "site")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """(l1, l2, first) of the lines on ``min_sites`` or more distinct sites."""
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "pos")
    spread = lines.groupBy("l1", "l2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"), F.min(at).alias("first"))
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    common = saved(spread.where(F.col("sites") >= low), "lines-common")
    near = common.where(F.col("sites") <= high)
    exact = (lines.join(near.select("l1", "l2"), ["l1", "l2"], "left_semi")
             .groupBy("l1", "l2").agg(F.countDistinct("site").alias("n")).where(F.col("n") >= min_sites))
    return (common.where(F.col("sites") > high).select("l1", "l2", "first")
            .unionByName(near.join(exact.select("l1", "l2"), ["l1", "l2"], "left_semi").select("l1", "l2", "first")))


def line_dedup(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN,
               lg_k: int = LG_K) -> DataFrame:
    """``docs`` without cross-site boilerplate lines, and ``removed_lines``.

    ``removed_lines`` holds the positions (from 0) that went; null if none did.
    """
    lines = saved(occurrences(docs, site), "lines-occurrences")
    common = boilerplate(lines, min_sites, margin, lg_k)
    here = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "pos")
    gone = (lines.join(common, ["l1", "l2"]).where(~here.eqNullSafe(F.col("first")))
            .select("k1", "k2", "pos").distinct()
            .groupBy(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).agg(F.sort_array(F.collect_list("pos")).alias("__gone")))
    k1, k2 = _keys(docs)
    columns = [c for c in docs.columns if c != "removed_lines"]
    rows = docs.withColumns({"__k1": k1, "__k2": k2}).join(gone, ["__k1", "__k2"], "left")
    split = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__gone"))
    text = F.array_join(F.transform(stay, lambda p: F.get(split, p)), "\n")
    rows = rows.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(text))
    return rows.select(*columns, F.col("__gone").alias("removed_lines"))
