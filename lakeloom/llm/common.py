"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark deletes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Written(threading.local):
    """Paths that stored() has written in this thread and release() hasn't deleted."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def __len__(self) -> int:
        return len(self.paths)


WRITTEN = Written()
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character alone. Where all are ASCII, lower() does just that, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A session that names none gets a folder of this machine, which only
    a local master, as in tests, can share with its executors; any other is refused."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="lakeloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(where)
    return where


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: the lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    WRITTEN.paths.append(path)
    # What the write shuffled is of no use once it is done; without this it would stay until the driver collects garbage.
    kept = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, kept)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Deletes what stored() has written in this thread from its `since`th table on, except what `keep` reads. Only for
    results that nothing will compute again."""
    kept = set(keep.inputFiles()) if keep is not None else set()
    for path in WRITTEN.paths[since:]:
        name = path.rsplit("/", 1)[-1]
        if not any(f"/{name}/" in f for f in kept):
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
            WRITTEN.paths.remove(path)


def same(a: Column, b: Column) -> Column:
    """Equality that also holds between two nulls; usable as a join key."""
    return a.eqNullSafe(b)


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """All columns of docs as one, `_row`, beside others: no name of theirs can clash. Select `_row.*` to get them back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(rows: DataFrame, gone: DataFrame, on: Column) -> DataFrame:
    """The rows that meet none of `gone`. The narrow side is hashed, so whole rows stream past it and no text is sorted."""
    return rows.join(gone.hint("shuffle_hash"), on, "left_anti")


def only(rows: DataFrame, found: DataFrame, on: Column) -> DataFrame:
    """The rows that meet one of `found`; like `without`."""
    return rows.join(found.hint("shuffle_hash"), on, "left_semi")
