"""Order-dependent rules: watermarks without gaps, stop rules over pages, overlapping intervals, stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contiguous_watermark(done: DataFrame, key: Sequence[str], seq: str, start: int = 1) -> DataFrame:
    """Per key: the largest n of which start..n are all done (start-1 if none), and how many beyond it are pending."""
    order = Window.partitionBy(*key).orderBy(seq)
    placed = done.select(*key, seq).distinct().where(F.col(seq) >= start).withColumn("_gap", F.col(seq) - F.row_number().over(order))
    run = F.col("_gap") == start - 1
    return placed.groupBy(*key).agg(F.coalesce(F.max(F.when(run, F.col(seq))), F.lit(start - 1)).cast("long").alias("watermark"), F.count_if(~run).alias("n_pending"))


def quiet_streak(pages: DataFrame, key: Sequence[str], order: str, n_new: str) -> DataFrame:
    """pages with `streak`: how many pages up to here in a row brought nothing new."""
    upto = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    part = F.sum(F.when(F.col(n_new) > 0, 1).otherwise(0)).over(upto)
    inner = Window.partitionBy(*key, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return pages.withColumn("_part", part).withColumn("streak", F.sum(F.when(F.col(n_new) > 0, 0).otherwise(1)).over(inner).cast("long")).drop("_part")


def stopped_at(pages: DataFrame, key: Sequence[str], order: str, n_new: str, after: int = 3) -> DataFrame:
    """Per key: the page at which a crawl stops, the first to end `after` pages without news; null if none does."""
    told = quiet_streak(pages, key, order, n_new)
    return told.groupBy(*key).agg(F.min(F.when(F.col("streak") >= after, F.col(order))).alias("stop_page"), F.count(F.lit(1)).alias("n_pages"))


def repeated_page(pages: DataFrame, key: Sequence[str], order: str, ids: str) -> DataFrame:
    """pages with `repeats`: the page's ids are those of the page before, or all seen before. A page is held against
    the place at which each of its ids came first, so no page carries those before it."""
    each = pages.select(*key, order, F.explode(F.array_distinct(ids)).alias("_id"))
    first = F.min(order).over(Window.partitionBy(*key, "_id"))
    fresh = each.withColumn("_first", first).groupBy(*key, order).agg(F.bool_or(F.col("_first") == F.col(order)).alias("_fresh"))
    same = F.coalesce(F.col(ids) == F.lag(ids).over(Window.partitionBy(*key).orderBy(order)), F.lit(False))
    out = pages.withColumn("_same", same).join(fresh, [*key, order], "left")
    return out.withColumn("repeats", F.col("_same") | ((F.size(ids) > 0) & ~F.coalesce("_fresh", F.lit(False)))).select(*pages.columns, "repeats")


def paging_stop(pages: DataFrame, key: Sequence[str], order: str, ids: str, n_new: str, empty: int = 1, known: int = 3) -> DataFrame:
    """Per key: stop_page and `why`, by the first rule that ends a paged crawl: `empty` pages without ids in a row,
    a repeated page, `known` pages in a row without anything new. On one page they count in this order."""
    told = repeated_page(pages, key, order, ids).withColumn("_size", F.size(ids))
    told = quiet_streak(told, key, order, "_size").withColumnRenamed("streak", "_empty")
    told = quiet_streak(told, key, order, n_new).withColumnRenamed("streak", "_known")
    why = F.when(F.col("_empty") >= empty, "empty").when(F.col("repeats"), "repeated").when(F.col("_known") >= known, "known")
    ended = told.withColumn("why", why).groupBy(*key).agg(F.min_by("why", F.when(F.col("why").isNotNull(), F.col(order))).alias("why"), F.min(F.when(F.col("why").isNotNull(), F.col(order))).alias("stop_page"))
    return ended.select(*key, "stop_page", "why")


def until_empty(pages: DataFrame, key: Sequence[str], order: str, n_items: str, start: int | None = None, most: int | None = None) -> DataFrame:
    """The pages before the first empty one, from page `start` on, and at most so many."""
    own = pages if start is None else pages.where(F.col(order) >= start)
    upto = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = own.withColumns({"_least": F.min(n_items).over(upto), "_at": F.row_number().over(Window.partitionBy(*key).orderBy(order))})
    return out.where((F.col("_least") > 0) & (F.lit(True) if most is None else F.col("_at") <= most)).drop("_least", "_at")


def harvested(batches: DataFrame, known: DataFrame, key: Sequence[str], order: str, id_: str, after: int = 3) -> DataFrame:
    """New items of a harvest that scrolls: of (key, order, id) those that aren't known, each at its first batch, up to
    the batch at which `after` batches in a row brought nothing new."""
    new = batches.join(known.select(id_).distinct(), id_, "left_anti").groupBy(*key, id_).agg(F.min(order).alias(order))
    per_batch = new.groupBy(*key, order).agg(F.count(F.lit(1)).alias("_n"))
    every = batches.select(*key, order).distinct().join(per_batch, [*key, order], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    stop = stopped_at(every, key, order, "_n", after).select(*key, "stop_page")
    return new.join(stop, list(key)).where(F.col("stop_page").isNull() | (F.col(order) <= F.col("stop_page"))).select(*key, order, id_)


def signature(rows: DataFrame, key: Sequence[str], pos: str, value: str) -> DataFrame:
    """Per key the values in their order; a page's rows, so bounded."""
    return rows.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct(pos, value))), lambda x: x[value]).alias("signature"))


def overlapping(intervals: DataFrame, key: Sequence[str], start: str, end: str) -> DataFrame:
    """intervals with `overlaps`: another of the key begins before this ends and ends after this begins. One sort
    instead of a join: with intervals in order of start, one overlaps an earlier one if the greatest end so far is over
    its start, and a later one if the next start is under its end."""
    order = Window.partitionBy(*key).orderBy(start, end)
    ended = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    following = F.lead(start).over(order)
    return intervals.withColumn("overlaps", F.coalesce(ended > F.col(start), F.lit(False)) | F.coalesce(following < F.col(end), F.lit(False)))


def has_overlap(intervals: DataFrame, key: Sequence[str], start: str, end: str) -> DataFrame:
    return overlapping(intervals, key, start, end).groupBy(*key).agg(F.bool_or("overlaps").alias("has_overlap"))


def next_stage(stages: DataFrame, completed: DataFrame) -> DataFrame:
    """The first stage by pos that isn't completed; no row if all are."""
    return stages.join(completed, "stage", "left_anti").orderBy("pos").limit(1)


def stage_size(instruments: DataFrame, least: int, most: int) -> DataFrame:
    """One row: how many different instruments a stage has, and whether that is within its bounds."""
    n = F.count_distinct(F.when(F.trim("instrument_id") != "", F.trim("instrument_id")))
    return instruments.agg(n.alias("n_instruments")).withColumn("valid", F.col("n_instruments").between(least, most))


def nested_prefixes(universe: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(stage_size, instrument_id, pos): the first n of the universe for each size; smaller ones lie in larger ones."""
    place = F.row_number().over(Window.orderBy("pos"))
    first = universe.orderBy("pos").limit(max(sizes)).withColumn("_r", place)
    each = F.explode(F.array(*[F.lit(n) for n in sizes])).alias("stage_size")
    return first.select("*", each).where(F.col("_r") <= F.col("stage_size")).select("stage_size", "instrument_id", "pos")


def no_backward_step(stage: Column, new: Column, stages: Sequence[str]) -> Column:
    """Whether a manifest may go from one stage to another: forward or stay; failed is reached from anywhere."""
    at = F.array(*map(F.lit, stages))
    return (new == "failed") | (F.array_position(at, new) >= F.array_position(at, stage))
