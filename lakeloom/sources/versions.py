"""Tables that are replaced as a whole: each save is a new folder beside the old ones, and a pointer names the one that
counts. Readers see the old table or the new one, never half of either; two writers can't both make a version."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> int:
    """The version that counts; 0 if there is none."""
    p, fs = _fs(spark, f"{root}/{POINTER}")
    if not fs.exists(p):
        return 0
    stream = fs.open(p)
    try:
        return int(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def folder(root: str, version: int) -> str:
    return f"{root}/v{version:010d}"


def load(spark: SparkSession, root: str, schema, version: int | None = None) -> DataFrame:
    """The table as of now, or of an earlier version; empty if it was never saved."""
    version = current(spark, root) if version is None else version
    return spark.read.schema(schema).parquet(folder(root, version)) if version else spark.createDataFrame([], schema)


def save(df: DataFrame, root: str, keep: int = 3) -> int:
    """Saves df, which may read the current version, and returns the new version. If another writer saves meanwhile,
    this one fails and changes nothing. The last `keep` versions stay."""
    spark = df.sparkSession
    version = current(spark, root) + 1
    df.write.mode("errorifexists").parquet(folder(root, version))
    p, fs = _fs(spark, f"{root}/{POINTER}.{version}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(str(version).encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(p, target, options)
    old, fs = _fs(spark, folder(root, version - keep))
    if version > keep and fs.exists(old):
        fs.delete(old, True)
    return version


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one. A session that names none has to be a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="lakeloom-")
    return f"{base.rstrip('/')}/lake-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: worked out once, here and now, and with no lineage behind it."""
    where = scratch(df.sparkSession)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)
