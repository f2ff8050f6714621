"""Connected components of a link table, as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkgraph.llm.common import saved_at
from linkgraph.session import remove_path


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (src, dst): root is the smallest id reachable.

    Alternating star contraction: each round every id hooks its larger
    neighbours to its smallest one ("large star"), then its smaller neighbours
    ("small star"), until the links form stars. The number of rounds grows with
    the logarithm of the longest chain. A round shuffles links by id; an id with
    very many neighbours is never gathered: its minimum is a partial aggregate,
    written before it is joined back, so that the join is plain and its hot side
    can be split. Each round is written to the shared folder, and what it was made
    from is removed once its links are written, so two rounds lie there at most.
    """
    spark = links.sparkSession
    edges, path = saved_at(_oriented(links.select("src", "dst")), "components")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        # Large star: src's smallest neighbour (or itself) gets the larger ones.
        used = [path]
        least, path = saved_at(both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("root")), "components-least")
        used.append(path)
        large = (both.where("dst > src").join(least, "src")
                 .select(F.col("dst").alias("src"), F.col("root").alias("dst")))
        edges, path = saved_at(_oriented(large), "components")
        used.append(path)
        # Small star: src's smaller neighbours, and src, hook to the smallest.
        least, path = saved_at(edges.groupBy("src").agg(F.min("dst").alias("root")), "components-least")
        used.append(path)
        hooked = edges.join(least, "src").select(
            F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("root").alias("b")),
                              F.struct(F.col("dst").alias("a"), F.col("root").alias("b")))).alias("e"))
        edges, path = saved_at(_oriented(hooked.select(F.col("e.a").alias("src"), F.col("e.b").alias("dst"))), "components")
        for old in used:
            remove_path(spark, old)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    ids = edges.select(F.col("src").alias("id"), F.col("dst").alias("root"))
    roots = edges.select(F.col("dst").alias("id"), F.col("dst").alias("root"))
    return ids.unionByName(roots).groupBy("id").agg(F.min("root").alias("root"))


def _oriented(edges: DataFrame) -> DataFrame:
    """Links with src > dst, each once, without self-links."""
    return (edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
            .where("src <> dst").distinct())


def _mark(edges: DataFrame) -> tuple:
    """What changes when the links change: their number and a sum of hashes."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return tuple(row)
