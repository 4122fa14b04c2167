"""Whole files: paths in one form, copies with verification, deletion behind a gate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules

#: Copies at once; the driver only starts them.
WORKERS = 8


def decoded(uri: Column) -> Column:
    """The path of a URI such as _metadata.file_path has (file:///a%20b), as it is written."""
    return F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri)


def plain_path(path: Column) -> Column:
    """A path in one form: file:///a, file:/a and /a are the same file."""
    return F.regexp_replace(path, "^file:/+", "/")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def size_of(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file; None if there is none."""
    p = _path(spark, path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).getLen() if fs.exists(p) else None


def copied(spark: SparkSession, todo: Sequence[tuple[str, str, int]]) -> list[str]:
    """`stored` or `present` for each (source, target, size). A copy gets its name only once it is whole."""
    conf = spark._jsc.hadoopConfiguration()

    def one(item: tuple[str, str, int]) -> str:
        source, target, size = item
        if size_of(spark, target) == size:
            return "present"
        a, b, part = _path(spark, source), _path(spark, target), _path(spark, f"{target}.part")
        fs = b.getFileSystem(conf)
        fs.mkdirs(b.getParent())
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, fs, part, False, True, conf)
        if size_of(spark, f"{target}.part") != size:
            raise OSError(f"the copy of {source} has another size")
        fs.delete(b, False)
        if not fs.rename(part, b):
            raise OSError(f"{target} can't be written")
        return "stored"

    with ThreadPoolExecutor(WORKERS) as pool:
        return list(pool.map(one, todo))


def uploaded(spark: SparkSession, files: DataFrame, root: str, dry_run: bool = False) -> DataFrame:
    """(file_path, remote_path, status) of catalog rows: `verified` if the copy has the catalog's size and sha256,
    `uploaded` if it hasn't the latter, `dry_run` if nothing was done. Sums are taken by the executors."""
    rows = files.select("file_path", "file_size", "sha256", F.concat(F.lit(f"{root}/"), F.regexp_replace(plain_path(F.col("file_path")), "^/+", "")).alias("remote_path"))
    if dry_run:
        return rows.select("file_path", "remote_path", F.lit("dry_run").alias("status"))
    todo = [(r["file_path"], r["remote_path"], r["file_size"]) for r in rows.collect()]
    copied(spark, todo)
    if not todo:
        return rows.select("file_path", "remote_path", F.lit("verified").alias("status"))
    there = spark.read.format("binaryFile").load([t for _, t, _ in todo])
    sums = there.select(plain_path(F.col("path")).alias("_p"), F.sha2("content", 256).alias("_sha"))
    met = rows.withColumn("_p", plain_path(F.col("remote_path"))).join(sums, "_p", "left")
    return met.select("file_path", "remote_path", F.when(F.col("_sha") == F.col("sha256"), "verified").otherwise("uploaded").alias("status"))


def cleaned(spark: SparkSession, gated: DataFrame, dry_run: bool = True) -> DataFrame:
    """gated: file_path and the steps of rules.GATE as booleans. (file_path, deleted, reason); a file goes only once all
    steps are done, with its sidecar (the path with .index.jsonl)."""
    told = gated.select("file_path", rules.cleanup_gate(**{c: F.col(c) for c in rules.GATE}).alias("_g"))
    out = told.select("file_path", F.col("_g.can_delete").alias("deleted"), F.col("_g.reason").alias("reason"))
    if dry_run:
        return out.withColumn("deleted", F.lit(False))
    delete(spark, (p for r in out.where("deleted").select("file_path").collect() for p in (r["file_path"], f"{r['file_path']}.index.jsonl")))
    return out


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        p = _path(spark, path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
