"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled by a fixed hash. A document's virtual
finish time is the number of words its source has sent up to and including it,
divided by the source's target; a document sent again comes one full pass of
its source later. Sorted by finish time, all sources stay in step with their
targets, and the mix is the front of that order: it stops at the total budget.

No source is one task: running sums are taken inside bounded ``(source,
bucket)`` pieces of the shuffle, bucket totals are carried forward, and the
global order is a histogram of finish times whose one boundary bin is cut again
in the same way until it is small, and then sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.llm.staging import staged

WORD = "[^\\x20\\x09-\\x0D]+"
ROWS_PER_BUCKET = 4_000
FINISH_BINS = 1 << 16
EDGE_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Words of a whole text, counted from the places where one starts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: dict, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> dict:
    """Target words per source. ``sizes``: words per source, null as None.
    Sources in code point order, null last, take ``weights`` in turn and share
    the total; a target stops at ``max_repeats`` times its source's size and
    what is over is shared again by weight until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] if None in sizes else []
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    # the sources that stop are those of the smallest limit for their weight
    open_ = sorted((s for s in order if sizes[s] > 0), key=lambda s: max_repeats * sizes[s] / weight[s])
    left, wide, full = float(sum(sizes.values())), float(sum(weight[s] for s in open_)), 0
    for s in open_:
        if left * weight[s] / wide <= max_repeats * sizes[s]:
            break
        left, wide, full = left - max_repeats * sizes[s], wide - weight[s], full + 1
    return {**dict.fromkeys(order, 0.0), **{s: float(max_repeats * sizes[s]) for s in open_[:full]},
            **{s: left * weight[s] / wide for s in open_[full:]}}


def _boundary(bins: DataFrame, budget: int) -> tuple[int, int, int]:
    """``(bin, words of the bins before it, rows in it)`` of the bin in which
    the budget ends; the one after the last if it doesn't."""
    sums = bins.groupBy("bin").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    edge, used = 0, 0
    for b, words, n in sorted(map(tuple, sums.collect())):  # 2 * FINISH_BINS rows at most
        if used + words > budget:
            return b, used, n
        edge, used = b + 1, used + words
    return edge, used, 0


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, seed: int = 13,
        columns: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``, ``source``): ``doc_id``,
    ``size`` (words), ``source_size``, ``target`` (its source's words in the
    mix), ``taken`` (words the mix takes from it, repeats counted: ``size``
    times the number of passes that reach it before the budget ends), then
    ``columns`` of the input as they are.

    A null text has size 0 and nothing is taken from it. A null source is a
    source of its own, last in order. Rows that repeat are mixed one by one;
    equal rows are ordered among themselves, so reruns agree up to which of
    two equal rows comes first. The budget is the size of all documents; it is
    met to within one document. An empty table gives an empty result.
    """
    keep = [F.col(c).alias(f"in_{c}") for c in columns]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       word_count(F.col("text").cast("string")).alias("size"), F.col("text").cast("string").alias("body"), *keep)
    # rows without an id are told apart by their texts
    name = F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("body"))).otherwise(F.col("doc_id"))
    rows = staged(rows.withColumn("h", F.xxhash64(name, "source", "size", F.lit(seed))).drop("body"), "mix")
    per_source = {r.source: (r.size, r.n) for r in  # one row for each source
                  rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    targets = source_targets({s: x[0] for s, x in per_source.items()}, weights, max_repeats)
    spark = docs.sparkSession
    info = spark.createDataFrame(
        [(s, i, per_source[s][0], targets[s], max(1, -(-per_source[s][1] // ROWS_PER_BUCKET)))
         for i, s in enumerate(targets)],
        "source string, source_no int, source_size long, target double, n_buckets int")
    # one small row for each source, bounded by the number of sources
    info_ref = F.broadcast(info) if len(per_source) <= 100_000 else info
    rows = rows.join(info_ref.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # buckets follow the hash, so bucket order is shuffle order
    spread = (F.shiftrightunsigned("h", 33) * F.col("n_buckets") / F.lit(1 << 31)).cast("int")
    rows = rows.withColumn("bucket", spread)
    totals = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("source_no", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("carried"))
    inside = (Window.partitionBy("source_no", "bucket").orderBy(F.shiftrightunsigned("h", 33), "h", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordered = (rows.withColumn("sent", F.sum("size").over(inside))
               .join(carried, ["source_no", "bucket"]).withColumn("sent", F.col("sent") + F.col("carried")))
    ordered = staged(ordered.drop("carried", "bucket", "n_buckets").withColumn("row", F.monotonically_increasing_id()), "mix-order")
    passes = (ordered.where("size > 0 and target > 0")
              .select("row", "size", "source_no", "source_size", "target", "sent",
                      F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("turn"))
              .select("row", "size", "source_no", "turn",
                      ((F.col("sent") + F.col("turn") * F.col("source_size")) / F.col("target")).alias("finish")))
    budget = sum(x[0] for x in per_source.values())
    # finish times up to the latest that can matter (all targets met is 1)
    bins = passes.withColumn("bin", F.floor(F.least("finish", F.lit(2.0)) * FINISH_BINS).cast("int"))
    edge, used, at_edge = _boundary(bins, budget)
    # the boundary bin is cut again until it is small, then taken in finish order
    whole, last, scaled = [bins.where(F.col("bin") < edge)], bins.where(F.col("bin") == edge), F.col("finish") * FINISH_BINS
    for _ in range(2):
        if at_edge <= EDGE_ROWS:
            break
        last = staged(last.withColumn("part", scaled - F.floor(scaled)), "mix-edge")
        scaled = F.col("part") * FINISH_BINS
        last = last.withColumn("bin", F.floor(scaled).cast("int"))
        edge, more, at_edge = _boundary(last, budget - used)
        whole.append(last.where(F.col("bin") < edge))
        last, used = last.where(F.col("bin") == edge), used + more
    run = Window.orderBy("finish", "source_no", "turn", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole.append(last.withColumn("run", F.sum("size").over(run)).where(F.col("run") <= budget - used))
    taken = reduce(DataFrame.union, [x.select("row", "size") for x in whole])
    taken = taken.groupBy("row").agg(F.sum("size").alias("taken"))
    return ordered.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        *(F.col(f"in_{c}").alias(c) for c in columns))
