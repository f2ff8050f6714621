"""Mixing sources to target weights along a time-varying curriculum.

Every source gets a target number of words: a share by weight of all words,
at most ``MOST_REPEATS`` times what the source has, the excess reshared by
weight until no target is above that (water filling, in whole numbers). A
source's weight changes over training time t in [0, 1] along a piecewise
linear schedule. Its integral G(t), scaled to the target, is the source's
cumulative token demand; a document whose words begin u words into its
source's stream is consumed where demand reaches u: at t = G^-1(u / target).
The stream of a source is its documents in hash order, again from the start
when it is used up. Documents are range-sorted by t.

The copy that crosses a source's target is cut after the target's last word,
so each source gives its target to the word, and no document more than
``MOST_REPEATS`` times its size.

Scale. Texts are read once, for (id, size, order key). The running sum of a
source has two levels: sums of buckets of the order key (a fixed prefix of a
hash, as long as needed for small buckets), then rows within a bucket, so a
source with a third of all rows is spread over its buckets. Sources are
weighed by their rank in code point order; ranks come from a range-partitioned
sort, targets from a prefix sum over another one. The number of sources never
matters to the driver, which sees a few sums per partition.

Cases: a null or blank text has size 0 and is never taken; a null source is a
source of its own, last in order; repeated rows count each; a null id sorts as
an empty one; no rows, or no words at all, give targets of 0; extra columns
are kept by ``mixed_documents`` and ignored by ``plan``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkgraph.llm.common import SPACES, WORD_GAP, saved, word_count

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BUCKET_ROWS = 20_000
WIDE = "decimal(38,0)"

#: Weight schedules, one per entry of WEIGHTS: (t, relative weight) knots. Heavy
#: sources open the training and fade, light ones come in towards its end.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.25), (0.75, 1.0), (1.0, 2.5)))


def integral(knots: tuple) -> list[tuple[float, float, float, float, float]]:
    """Per segment (t0, t1, w0, w1, integral up to t0), scaled to a total of 1."""
    total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    out, done = [], 0.0
    for a, b in zip(knots, knots[1:]):
        out.append((a[0], b[0], a[1] / total, b[1] / total, done))
        done += (b[0] - a[0]) * (a[1] + b[1]) / 2 / total
    return out


def demand_time(u: Column, knots: tuple) -> Column:
    """t at which the schedule's integral reaches ``u`` in [0, 1]."""
    out, after = F.lit(1.0), None
    for t0, t1, w0, w1, done in reversed(integral(knots)):
        slope = (w1 - w0) / (t1 - t0)
        left = F.greatest(u - F.lit(done), F.lit(0.0))
        # Root of w0 x + slope x^2 / 2 = left, in the form that also holds for slope 0.
        under = F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * left, F.lit(0.0))
        x = F.when(left > 0, F.lit(2.0) * left / (F.lit(w0) + F.sqrt(under))).otherwise(0.0)
        t = F.least(F.lit(t0) + x, F.lit(t1))
        out = t if after is None else F.when(u < F.lit(after), t).otherwise(out)
        after = done
    return out


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0) by code point order of ``source``, null last."""
    # Ordered parts of bounded number; only their row counts reach the driver.
    order = [F.col("source").isNull(), F.col("source")]
    parts = saved(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sources")
    counts = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, seen = [F.lit(-1), F.lit(0).cast("long")], 0
    for part in sorted(counts):
        before += [F.lit(part), F.lit(seen).cast("long")]
        seen += counts[part]
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("rank", F.create_map(*before)[F.col("part")] + within).drop("part")


def _two(caps: int, weights: int) -> Column:
    return F.struct(F.lit(str(caps)).cast(WIDE).alias("caps"), F.lit(str(weights)).cast(WIDE).alias("weights"))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size) with weight class and ``target`` words, as a double.

    A rising level reaches the sources' caps (``most`` times their size) in
    order of cap per weight, so those it caps are the first ones in that order:
    one prefix sum over the distinct ratios finds them, however many there are.
    """
    ranked = ranked_sources(sources)
    unit = math.lcm(*weights)
    cls = (F.col("rank") % len(weights)).cast("int")
    per_weight = F.element_at(F.array(*[F.lit(unit // w) for w in weights]), cls + 1).cast(WIDE)
    cap = F.lit(most) * F.col("source_size")
    weighed = saved(ranked.withColumns({
        "cls": cls, "weight": F.element_at(F.array(*[F.lit(w) for w in weights]), cls + 1).cast("long"),
        "ratio": cap.cast(WIDE) * per_weight}), "mix-weights")
    total, every = (x or 0 for x in weighed.agg(F.sum("source_size"), F.sum("weight")).first())

    # Sources of equal ratio are capped together, so many of them are one row here.
    steps = weighed.groupBy("ratio").agg(F.sum(cap).cast(WIDE).alias("caps"), F.sum("weight").cast(WIDE).alias("weights"))
    steps = saved(steps.repartitionByRange("ratio").withColumn("part", F.spark_partition_id()), "mix-steps")
    before, caps, held = [F.lit(-1), _two(0, 0)], 0, 0
    for r in steps.groupBy("part").agg(F.sum("caps"), F.sum("weights")).orderBy("part").collect():
        before += [F.lit(r[0]), _two(caps, held)]
        caps, held = caps + int(r[1]), held + int(r[2])
    within = Window.partitionBy("part").orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.create_map(*before)[F.col("part")]
    none = F.lit(0).cast(WIDE)
    spent = (offset["caps"] + F.coalesce(F.sum("caps").over(within), none)).cast(WIDE)
    gone = (offset["weights"] + F.coalesce(F.sum("weights").over(within), none)).cast(WIDE)
    # Below the level that is left once all before are capped: ratio / unit < rest / weights left, in whole numbers.
    short = "decimal(19,0)"
    reached = (F.col("ratio") * (F.lit(every).cast(WIDE) - gone).cast(short)
               < F.lit(unit).cast(short) * (F.lit(total).cast(WIDE) - spent).cast(WIDE))
    full = steps.withColumn("reached", reached).where("reached").agg(F.sum("caps"), F.sum("weights"), F.max("ratio")).first()
    rest, weight = total - int(full[0] or 0), every - int(full[1] or 0)
    capped = F.col("ratio") <= F.lit(-1 if full[2] is None else full[2]).cast(WIDE)
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(max(weight, 1)).cast("double")
    return weighed.withColumn("target", F.when(capped, cap.cast("double")).otherwise(share)).drop("ratio")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, order, row) per row; ``order`` is a hash of id and
    text, ``row`` of all columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       word_count(F.col("text")).alias("size"), order_key().alias("order"), F.xxhash64(*docs.columns).alias("row"))


def order_key() -> Column:
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, schedules: tuple = SCHEDULES,
         bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """What the mix takes, one row per row of ``docs``.

    (doc_id, source, order, row, size, source_size, target, taken, copies):
    ``copies`` has (t, words) of each copy taken, when in training it begins and
    its words; ``taken`` is their sum.
    """
    rows = saved(sizes(docs), "mix-sizes")
    totals = saved(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), "mix-totals")
    largest = totals.agg(F.max("rows")).first()[0] or 0
    # Enough buckets for their size, and for one source to fill all tasks.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = max(1, math.ceil(math.log(max(largest / bucket_rows, tasks), 16)))
    bucket = F.substring("order", 1, digits)
    aim = targets(totals.select("source", "source_size"), weights, most)

    # First level: words of the source before each bucket.
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    sums = sums.select("source", "bucket", before.alias("before"))
    aimed = sums.alias("s").join(aim.alias("a"), F.col("s.source").eqNullSafe(F.col("a.source"))).select(
        F.col("s.source").alias("b_source"), F.col("s.bucket").alias("b_bucket"), "before", "source_size", "target", "cls")

    # Second level: words of the bucket before each row.
    within = Window.partitionBy("source", "bucket").orderBy("order", "row", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("bucket", bucket).withColumn("within", F.sum("size").over(within) - F.col("size"))
    placed = placed.join(aimed, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))

    # Copy e begins e * source_size words later; what lies past the target is not taken.
    copies = []
    for e in range(most):
        begin = F.col("before") + F.col("within") + F.lit(e).cast("long") * F.col("source_size")
        words = F.least(F.ceil("target") - begin, F.col("size"))
        u = begin.cast("double") / F.col("target")
        t = F.lit(None).cast("double")
        for k, knots in enumerate(schedules):
            t = F.when(F.col("cls") == k, demand_time(u, knots)).otherwise(t)
        copies.append(F.when(words > 0, F.struct(t.alias("t"), words.alias("words"))))
    out = placed.withColumn("copies", F.filter(F.array(*copies), lambda c: c.isNotNull()))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["words"])
    return out.select("doc_id", "source", "order", "row", "size", "source_size", "target", taken.alias("taken"), "copies")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix: a row per copy taken, columns of ``docs``, range-sorted by t.

    A copy that is taken in part keeps its text up to the last word taken.
    """
    options = {"weights": WEIGHTS, "most": MOST_REPEATS, "schedules": SCHEDULES} | options
    taken = plan(docs, **options).select(
        F.col("order").alias("__order"), F.col("row").alias("__row"), F.col("size").alias("__size"), F.explode("copies").alias("__copy"))
    # Equal rows have equal keys; their copies are all in ``taken``.
    texts = docs.withColumns({"__order": order_key(), "__row": F.xxhash64(*docs.columns)}).dropDuplicates(["__order", "__row"])
    rows = texts.join(taken, ["__order", "__row"])
    words = F.col("__copy.words")
    from_word = F.ltrim("text", F.lit(SPACES))
    rest = F.element_at(F.split(from_word, WORD_GAP, (words + 1).cast("int")), -1)
    cut = F.rtrim(F.expr("substring(text, 1, length(text) - __rest)"), F.lit(SPACES))
    rows = rows.withColumn("__rest", F.when(words < F.col("__size"), F.length(rest)).otherwise(0))
    rows = rows.withColumn("text", F.when(words < F.col("__size"), cut).otherwise(F.col("text")))
    ordered = rows.orderBy(F.col("__copy.t"), "__order", "__row", F.col("__copy.words"))
    return ordered.select(*docs.columns)
