"""The file catalog as a DataFrame: listings, upserts and state changes. One row stands for one Parquet file.

Every change gives a new DataFrame; save() writes it as a new version beside the old one and then moves the pointer,
so readers never see half a catalog (see versions.py).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import DATA_FILE
from . import versions

KEY = "file_path"
#: What an upsert may change: a file's description, never its storage or lifecycle.
DESCRIPTION = ["site_id", "country", "dataset", "partition_date", "bucket", "sha256", "row_count", "file_size", "min_event_time", "max_event_time", "schema_version"]


def visible(files: DataFrame) -> DataFrame:
    return files.where((F.col("storage_status") == "uploaded") & (F.col("lifecycle_status") == "active"))


def listing(files: DataFrame, site_id: str, dataset: str, country: str | None = None, first: dt.date | None = None, last: dt.date | None = None, date: dt.date | None = None, buckets: Iterable[str] | None = None) -> DataFrame:
    """Visible files by date (exact or an inclusive range) and buckets, in the order of date, bucket, id."""
    if first and last and first > last:
        raise ValueError("the range is reversed")
    out = visible(files).where((F.col("site_id") == site_id) & (F.col("dataset") == dataset))
    if country:
        out = out.where(F.col("country") == country.strip().upper())
    if date:
        out = out.where(F.col("partition_date") == F.lit(date))
    if first:
        out = out.where(F.col("partition_date") >= F.lit(first))
    if last:
        out = out.where(F.col("partition_date") <= F.lit(last))
    if buckets is not None:
        names = sorted(set(buckets))
        if not names:
            raise ValueError("buckets must not be empty")
        out = out.where(F.col("bucket").isin(names))
    return in_order(out)


def in_order(files: DataFrame) -> DataFrame:
    return files.orderBy("partition_date", "bucket", "id")


def by_path(files: DataFrame, path: str) -> DataFrame:
    return files.where(F.col(KEY) == path).limit(1)


def distinct_files(files: DataFrame) -> DataFrame:
    return files.dropDuplicates(["id", KEY])


def local_active(files: DataFrame) -> DataFrame:
    return files.where((F.col("storage_status") == "local") & (F.col("lifecycle_status") == "active"))


def upserted(files: DataFrame, incoming: DataFrame) -> DataFrame:
    """New paths come in as local and active; known ones get a new description and keep their states."""
    new = incoming.select(KEY, *[F.col(c).alias(f"_{c}") for c in DESCRIPTION], F.lit(True).alias("_new"))
    both = files.join(new, KEY, "full_outer")
    last = files.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    # Only new files get numbers, so the numbering covers what comes in.
    known = both.where(F.col("id").isNotNull()).withColumn("_id", F.col("id"))
    added = numbered(both.where(F.col("id").isNull()), [f"_{c}" for c in DESCRIPTION[:5]], KEY).crossJoin(F.broadcast(last))
    merged = known.unionByName(added.withColumn("_id", F.col("_last") + F.col("_place")).drop("_last", "_place"))
    keep = lambda c: F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    return merged.select(
        F.col("_id").cast("long").alias("id"), *[keep(c) for c in DESCRIPTION[:5]], KEY, *[keep(c) for c in DESCRIPTION[5:]],
        F.coalesce("storage_status", F.lit("local")).alias("storage_status"), F.coalesce("lifecycle_status", F.lit("active")).alias("lifecycle_status"), "remote_path",
    ).select(*DATA_FILE.fieldNames())


def numbered(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """rows with `_place`: numbers from 1 without gaps, by group, then key. A group is numbered by itself, after the
    sizes of the groups before it, so only one row a group meets in one task."""
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_c"))
    order = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*[F.col(c).alias(f"{c}2") for c in group], F.coalesce(F.sum("_c").over(order), F.lit(0)).alias("_before"))
    inner = rows.withColumn("_in", F.row_number().over(Window.partitionBy(*group).orderBy(key)))
    met = inner.join(before, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{c}2")) for c in group]))
    return met.withColumn("_place", F.col("_before") + F.col("_in")).drop("_in", "_before", *[f"{c}2" for c in group])


def changed(files: DataFrame, paths: Iterable[str] | DataFrame, **values: Column | str | None) -> DataFrame:
    """The named columns of the files at `paths` (a list, or a DataFrame with file_path) get new values."""
    if isinstance(paths, DataFrame):
        hit = paths.select(KEY, F.lit(True).alias("_hit")).distinct()
        files = files.join(hit, KEY, "left")
    else:
        files = files.withColumn("_hit", F.col(KEY).isin(list(paths)))
    for name, value in values.items():
        files = files.withColumn(name, F.when(F.coalesce("_hit", F.lit(False)), value if isinstance(value, Column) else F.lit(value)).otherwise(F.col(name)))
    return files.select(*DATA_FILE.fieldNames())


def mark_uploaded(files: DataFrame, remote: DataFrame) -> DataFrame:
    """remote: file_path, remote_path."""
    paths = remote.select(KEY, F.col("remote_path").alias("_remote"))
    met = files.join(paths, KEY, "left")
    met = met.withColumn("storage_status", F.when(F.col("_remote").isNotNull(), "uploaded").otherwise(F.col("storage_status")))
    return met.withColumn("remote_path", F.coalesce("_remote", "remote_path")).select(*DATA_FILE.fieldNames())


def mark_superseded(files: DataFrame, paths: Iterable[str] | DataFrame) -> DataFrame:
    return changed(files, paths, lifecycle_status="superseded")


def mark_active(files: DataFrame, paths: Iterable[str] | DataFrame) -> DataFrame:
    return changed(files, paths, lifecycle_status="active")


def mark_archived(files: DataFrame, paths: Iterable[str] | DataFrame) -> DataFrame:
    return changed(files, paths, lifecycle_status="archived")


def with_lifecycle(files: DataFrame) -> DataFrame:
    """A catalog from before there was a lifecycle: all files are active."""
    if "lifecycle_status" in files.columns:
        return files.withColumn("lifecycle_status", F.coalesce("lifecycle_status", F.lit("active")))
    return files.withColumn("lifecycle_status", F.lit("active"))


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DATA_FILE)


def save(files: DataFrame, root: str) -> int:
    """Saves the catalog as the next version at root and returns its number."""
    return versions.save(files.select(*DATA_FILE.fieldNames()), root)


def load(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The saved catalog; an empty one if there is none."""
    return versions.load(spark, root, DATA_FILE, version)


def register(spark: SparkSession, root: str, incoming: DataFrame) -> DataFrame:
    """Upserts file descriptions into the saved catalog and returns it."""
    save(upserted(load(spark, root), incoming), root)
    return load(spark, root)
