"""Mixing sources to target weights along a curriculum that changes over training.

A source's weight is a piecewise-linear function of training time in [0, 1].  Its integral gives the
source's share of all words, its running integral the demand for the source's words up to a time.
Inverting that demand gives each document copy its training position, by which the mix is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.text import stored, word_count

#: Schedules by rank of the source, repeating: (time, weight) knots with integrals 5, 2 and 1.
SCHEDULES = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
#: No document is taken more often than this.
MAX_REPEATS = 3


def with_size(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `size`, the number of words; 0 for null."""
    return docs.withColumn("size", word_count(F.col(text)))


def ranked_schedules(sources: DataFrame) -> DataFrame:
    """`SCHEDULES` dealt to the sources in code point order, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.array(*(
        F.array(*(F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in knots)) for knots in SCHEDULES
    ))
    return sources.withColumn("knots", F.get(choice, (rank % len(SCHEDULES)).cast("int")))


def _segments(knots: Column) -> Column:
    """Segments with start `t`, weights `a` and `b`, length `h` and the integral `upto` their start."""
    pieces = F.transform(F.sequence(F.lit(1), F.size(knots) - 1), lambda i: F.struct(
        F.get(knots, i - 1)["t"].alias("t"), F.get(knots, i - 1)["w"].alias("a"), F.get(knots, i)["w"].alias("b"),
        (F.get(knots, i)["t"] - F.get(knots, i - 1)["t"]).alias("h")))
    area = lambda p: (p["a"] + p["b"]) * p["h"] / 2
    before = lambda i: F.aggregate(F.slice(pieces, 1, i), F.lit(0.0), lambda s, p: s + area(p))
    return F.transform(pieces, lambda p, i: F.struct(
        p["t"].alias("t"), p["a"].alias("a"), p["b"].alias("b"), p["h"].alias("h"), before(i).alias("upto")))


def _integral(knots: Column) -> Column:
    return F.aggregate(
        F.transform(F.sequence(F.lit(1), F.size(knots) - 1), lambda i: (
            F.get(knots, i - 1)["w"] + F.get(knots, i)["w"]) * (F.get(knots, i)["t"] - F.get(knots, i - 1)["t"]) / 2),
        F.lit(0.0), lambda s, x: s + x)


def position_at(segments: Column, demand: Column) -> Column:
    """The time at which a schedule's running integral reaches `demand`."""
    at = F.element_at(F.filter(segments, lambda p: p["upto"] <= demand), -1)
    rest, slope = demand - at["upto"], (at["b"] - at["a"]) / at["h"]
    root = F.sqrt(at["a"] * at["a"] + 2 * slope * rest)
    bottom = at["a"] + root
    return at["t"] + F.when(bottom > 0, 2 * rest / bottom).otherwise(0.0)


def targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add `weight` and `target` to sources with `source_size` and `knots`.

    A target is the smaller of `max_repeats` times the source's size and level * weight, with the one
    level at which all targets sum to the sum of all sizes: where the first bounds are reached, the
    excess is shared out by weight among the rest, until none is above its bound.  Sources sorted
    by bound per weight reach theirs in that order, which gives the level in one pass.  A weight of
    zero gets nothing.  There is one row per source, and that list alone is sorted as a whole.
    """
    rows = sources.withColumn("weight", _integral(F.col("knots")))
    bound = F.lit(float(max_repeats)) * F.col("source_size")
    by_level = Window.orderBy((bound / F.col("weight")).asc_nulls_last(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.sum("source_size").over(everything) - F.coalesce(F.sum(bound).over(earlier), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    rows = rows.withColumn("_m_level", F.when(left_weight > 0, left_words / left_weight))
    # the first source whose bound lies above its share fixes the level of it and all that follow
    fixed = F.when(F.col("_m_level") * F.col("weight") <= bound, F.col("_m_level"))
    level = F.min_by(fixed, F.when(fixed.isNotNull(), F.struct(
        bound / F.col("weight"), F.col("source").isNull(), F.col("source")))).over(everything)
    target = F.when(F.col("weight") > 0, F.least(bound, F.coalesce(level * F.col("weight"), bound))).otherwise(0.0)
    return rows.withColumn("target", target).drop("_m_level")


def _unit(order_by: Column) -> Column:
    """A number in [0, 1) from the first 48 bits of an MD5."""
    return F.conv(F.substring(F.md5(order_by), 1, 12), 16, 10).cast("double") / float(1 << 48)


def assign(
    sized: DataFrame, schedules=ranked_schedules, source: str = "source", key: str = "doc_id",
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Add `source_size`, `target`, `taken` and `positions` to documents that have a `size`.

    A source's documents, in an order drawn from an MD5 of `key`, form a stream of words that is read
    again from its start as long as the target asks for it.  All documents are taken floor(target /
    source size) times; those whose middle lies within what then remains are taken once more, so a
    source misses its target by less than one document.  `positions` holds the training time of each
    copy, empty for documents that are not taken; `taken` is `size` times the number of copies.

    Running sums are made in ranges of the sorted table, one per shuffle partition, plus a sum over ranges.  So a
    hot source is spread over many tasks, and so is a key that many rows share, or none: equal rows are told apart
    by a number that has no other use.  There is one row per source, and that list alone is sorted as a whole:
    sources are meant to be thousands, not billions.  A null source is a source; a null key
    orders as an empty one.  Rows with equal keys follow each other by size; equal rows share their
    copies in some order.  Documents without words have no copies beyond the whole rounds.  An
    empty table stays empty.  Columns of the added names are replaced.  The rows are stored once, so pass a narrow table.
    """
    # "s" or "n" in front keeps a null source apart from any other
    named = F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source)))
    kept = [c for c in sized.columns if c not in ("source_size", "target", "taken", "positions")]
    order = ["_m_u", "_m_key", "_m_size", "_m_copy"]
    # the caller's columns travel as one, so none of theirs meets one of these; stored with the number of their range
    rows = stored(sized.select(
        F.struct(*kept).alias("_m_row"), F.col("size").cast("long").alias("_m_size"), named.alias("_m_source"),
        F.col(source).alias("_m_origin"), F.col(key).alias("_m_key"),
        _unit(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_m_u"), F.monotonically_increasing_id().alias("_m_copy"),
    ).repartitionByRange("_m_source", *order).withColumn("_m_range", F.spark_partition_id()), "ordered")
    # stored, so that sums are made by source and range, not by source alone as the window asks
    ranges = stored(rows.groupBy("_m_source", "_m_origin", "_m_range").agg(F.sum("_m_size").alias("_m_sum")), "ranges")
    # stored, so that Spark knows its size and need not shuffle documents by source to join it
    plan = stored(targets(schedules(ranges.groupBy("_m_source", F.col("_m_origin").alias("source")).agg(
        F.sum("_m_sum").alias("source_size"))), max_repeats).select(
        "_m_source", "source_size", "target", F.col("weight").alias("_m_weight"), _segments(F.col("knots")).alias("_m_segments")), "plan")
    earlier = Window.partitionBy("_m_source").orderBy("_m_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "_m_source", "_m_range", F.coalesce(F.sum("_m_sum").over(earlier), F.lit(0)).alias("_m_offset"))
    before = Window.partitionBy("_m_source", "_m_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(offsets.join(plan, "_m_source"), ["_m_source", "_m_range"]).withColumn(
        "_m_before", F.col("_m_offset") + F.coalesce(F.sum("_m_size").over(before), F.lit(0)))
    # rounds over the whole source, and the words still missing after them
    size = F.col("source_size").cast("double")
    rounds = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0))
    rest = F.col("target") - rounds * size
    once_more = (F.col("_m_before") + F.col("_m_size") / 2 < rest) & (rounds < max_repeats)
    copies = (rounds + F.when(once_more, 1).otherwise(0)).cast("int")
    demand = lambda c: (c * size + F.col("_m_before")) / F.col("target") * F.col("_m_weight")
    return rows.withColumn("_m_copies", copies).select(
        *(F.col("_m_row")[c].alias(c) for c in kept), "source_size", "target",
        (F.col("_m_copies") * F.col("_m_size")).alias("taken"),
        F.when(
            (F.col("_m_copies") > 0) & (F.col("target") > 0),
            F.transform(F.sequence(F.lit(0), F.col("_m_copies") - 1),
                        lambda c: position_at(F.col("_m_segments"), demand(c))),
        ).otherwise(F.array().cast("array<double>")).alias("positions"))


def training_order(assigned: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per copy with its `position`, range-sorted by it; documents with no copy vanish.

    Ties, such as documents without words, follow each other by key.
    """
    copies = assigned.withColumn("position", F.explode("positions")).drop("positions")
    return copies.repartitionByRange("position", key).sortWithinPartitions("position", key)


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The copies of documents that the mix takes, in training order, with the columns they came with.

    Whole rows travel as one column, so none of theirs is replaced.  They are stored with their sizes and a number,
    by which they meet the positions found for number, source, key and size alone.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("_m_whole"), F.monotonically_increasing_id().alias("_m_id"),
        F.col(source).alias("_m_from"), F.col(key).alias("_m_name"), word_count(F.col(text)).alias("size"))
    rows = stored(rows, "sized")
    found = assign(rows.drop("_m_whole"), source="_m_from", key="_m_name").where(F.size("positions") > 0)
    copies = rows.select("_m_whole", "_m_id").join(found.select("_m_id", "_m_name", "positions"), "_m_id")
    return training_order(copies, "_m_name").select(*(F.col("_m_whole")[c].alias(c) for c in docs.columns))
