"""Compaction: planning, the latest version of each record, publishing and its checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import COLUMNS, RECORD
from ..sources import catalog
from ..sources.files import decoded, plain_path

GROUP = ["site_id", "country", "dataset", "partition_date", "bucket"]


def plan(files: DataFrame, least_files: int = 2) -> DataFrame:
    """Groups of visible files worth compacting: n_files, n_rows, n_bytes and the ids in order."""
    out = catalog.visible(files).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_files"), F.sum("row_count").alias("n_rows"), F.sum("file_size").alias("n_bytes"), F.sort_array(F.collect_list("id")).alias("file_ids"))
    return out.where(F.col("n_files") >= least_files).orderBy(*GROUP)


def version_time() -> Column:
    return F.coalesce("crawled_at", "updated_at", "event_time")


def latest(records: DataFrame, place: Sequence[str], key: str = "record_uid") -> DataFrame:
    """One row per key: the one with the greatest version time, of equal ones the last by `place` (a total order of
    the rows, such as file and position). Aggregates before the shuffle, so a hot key is no hot task."""
    rank = F.struct(version_time().isNotNull().alias("a"), version_time().alias("b"), *[F.col(c) for c in place])
    best = records.groupBy(F.coalesce(F.col(key), F.lit("None")).alias("_k")).agg(F.max_by(F.struct(*records.columns), rank).alias("_r"))
    return best.select("_r.*")


def compacted(records: DataFrame, place: Sequence[str]) -> DataFrame:
    return latest(records, place).orderBy(F.asc_nulls_last("event_time"), "record_uid")


def summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after, distinct keys, duplicates removed and left."""
    a = before.agg(F.count(F.lit(1)).alias("rows_before"), F.count_distinct("record_uid").alias("keys"))
    b = after.agg(F.count(F.lit(1)).alias("rows_after"), F.count_distinct("record_uid").alias("_keys"))
    return a.crossJoin(b).select("rows_before", "rows_after", "keys", (F.col("rows_before") - F.col("rows_after")).alias("removed"), (F.col("rows_after") - F.col("_keys")).alias("duplicates_left"))


def one_schema_version(records: DataFrame) -> DataFrame:
    """records, failing where they mix schema versions."""
    spread = records.agg(F.count_distinct("schema_version").alias("n"), F.min("schema_version").alias("v")).first()
    if spread["n"] > 1:
        raise ValueError("schema versions are mixed")
    return records


def read_group(spark: SparkSession, chosen: DataFrame) -> DataFrame:
    """The rows of catalog files with `_id` and the group of their file. The remote copy is read where there is one.
    Paths are compared in one form, so blanks and letters beyond ASCII don't matter; a file without a catalog row,
    one that can't be read and one with other rows than the catalog says are errors."""
    paths = [r[0] for r in chosen.select(F.coalesce("remote_path", "file_path")).collect()]
    rows = spark.read.schema(RECORD).parquet(*paths)
    rows = rows.withColumns({"_file": plain_path(decoded(F.col("_metadata.file_path"))), "_pos": F.col("_metadata.row_index")})
    ids = chosen.select(*[F.col(c).alias(f"_{c}") for c in GROUP], plain_path(F.coalesce("remote_path", "file_path")).alias("_path"), F.col("id").alias("_id"), "row_count")
    counted = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).join(ids, F.col("_file") == F.col("_path"), "full_outer")
    wrong = counted.where(F.coalesce("n", F.lit(0)) != F.coalesce("row_count", F.lit(-1))).select(F.coalesce("_path", "_file").alias("path"), "n", "row_count").limit(3).collect()
    if wrong:
        raise ValueError("; ".join(f"{r['path']}: {r['n'] or 0} rows, the catalog says {r['row_count']}" for r in wrong))
    return rows.join(ids.drop("row_count"), F.col("_file") == F.col("_path"))


def compact_dataset(spark: SparkSession, files: DataFrame, where: str, publish: Callable[[str], DataFrame], least_files: int = 2, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(plan, catalog after it). All groups are one job: rows are read with their group, the latest of each group and
    key are written (a large group by several tasks), published and registered, and only then are the sources
    superseded. Whatever fails before leaves the catalog as it was.

    publish(path) is called once and gives the catalog rows of what was written there, as uploaded.
    """
    todo = plan(files, least_files)
    if dry_run:
        return todo, files
    chosen = catalog.visible(files).join(todo.select(*GROUP), GROUP, "left_semi")
    if chosen.isEmpty():
        return todo, files
    met = read_group(spark, chosen)
    keys = [f"_{c}" for c in GROUP]
    rank = F.struct(version_time().isNotNull().alias("a"), version_time().alias("b"), "_id", "_pos")
    best = met.groupBy(*keys, "record_uid").agg(F.max_by(F.struct(*COLUMNS), rank).alias("_r")).select(*keys, "_r.*")
    names = dict(zip(keys, ["p_site", "p_country", "p_dataset", "p_date", "p_bucket"], strict=True))
    best = best.withColumnsRenamed(names).hint("rebalance", *names.values()).sortWithinPartitions(*names.values(), F.asc_nulls_last("event_time"), "record_uid")
    best.write.mode("errorifexists").option("compression", "zstd").partitionBy(*names.values()).parquet(where)
    made = publish(where)
    after = catalog.upserted(files, made)
    after = catalog.mark_uploaded(after, made.select("file_path", F.col("file_path").alias("remote_path")))
    return todo, catalog.mark_superseded(after, chosen.select("file_path"))


def overlap(a: DataFrame, b: DataFrame, path: str = "file_path") -> DataFrame:
    """Paths in both; must be empty before old files are retired."""
    return a.select(path).intersect(b.select(path))


def published_check(before: DataFrame, after: DataFrame, state: DataFrame) -> DataFrame:
    """One row that says whether a compaction may be published: n_rows after it, n_lost and n_extra keys against the
    rows before, n_missing and n_mismatch against the state, and `ok`."""
    lost = before.select("record_uid").distinct().join(after, "record_uid", "left_anti").agg(F.count(F.lit(1)).alias("n_lost"))
    extra = after.select("record_uid").distinct().join(before, "record_uid", "left_anti").agg(F.count(F.lit(1)).alias("n_extra"))
    # One row each.
    out = rebuilt_check(after, state).crossJoin(lost).crossJoin(extra)
    return out.withColumn("ok", (F.col("n_lost") == 0) & (F.col("n_extra") == 0) & (F.col("n_missing") == 0) & (F.col("n_mismatch") == 0))


def retired(files: DataFrame, old: DataFrame, keep: DataFrame) -> DataFrame:
    """The catalog after `old` paths are archived; a path that is also to be kept is an error."""
    both = overlap(old, keep).limit(1).collect()
    if both:
        raise ValueError(f"still in use: {both[0][0]}")
    return catalog.mark_archived(files, old.select("file_path"))


def rehashed(state: DataFrame, records: DataFrame) -> DataFrame:
    """The state with each record's version hash as it is computed now (records: rebuilt, with version_hash); states
    without a record stay."""
    now = records.groupBy("record_uid").agg(F.max_by("version_hash", F.struct(version_time().isNotNull(), version_time())).alias("_now"))
    return state.join(now, "record_uid", "left").select("record_uid", F.coalesce("_now", "version_hash").alias("version_hash"))


def rebuilt_check(rebuilt: DataFrame, state: DataFrame) -> DataFrame:
    """One row: rebuilt rows, and those that the state lacks or has with another version."""
    known = state.select("record_uid", F.col("version_hash").alias("_known"))
    met = rebuilt.join(known, "record_uid", "left")
    return met.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_known").isNull()).alias("n_missing"), F.count_if(F.col("_known") != F.col("version_hash")).alias("n_mismatch"))
