"""Reading and writing the partitioned record lake, sidecars, universes and state."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import identity as ident
from ..functions.dates import iso_time
from ..functions.sites import is_canonical
from ..functions.text import optional
from ..model import COLUMNS, RECORD, STATE, DatasetSpec
from . import files as fs
from . import versions

PARTITIONS = ["site", "country_code", "dataset_name", "year", "month", "day", "bucket"]


def canonical(df: DataFrame, spec: DatasetSpec, strict: bool = False) -> DataFrame:
    """Rows with the record columns, stripped and checked, identified and versioned.

    Missing columns are null. `payload` (map or struct) and `relations` (array of structs) become JSON with sorted
    keys. strict: a row that lacks what it needs is an error; else rejected() has it and this has not.
    """
    own = described(df, spec)
    bad = problems(own)
    own = own.withColumn("_bad", F.when(F.size(bad) > 0, F.raise_error(F.array_join(bad, "; ")).cast("string"))).where(F.col("_bad").isNull()).drop("_bad") if strict else own.where(F.size(bad) == 0)
    return identified(own)


def rejected(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The rows that are no records, as far as they are described, with `problems`: why."""
    own = described(df, spec)
    return own.withColumn("problems", problems(own)).where(F.size("problems") > 0).drop("_it", "_ii", "_rel")


def described(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    text = lambda c: optional(F.col(c)) if c in df.columns else F.lit(None).cast("string")
    time = lambda c: record_time(df, c) if c in df.columns else F.lit(None).cast("timestamp")
    relations = F.col("relations") if "relations" in df.columns else F.lit(None).cast("array<struct<instrument_id:string,relation_type:string,confidence:double>>")
    return df.select(
        (F.col("schema_version") if "schema_version" in df.columns else F.lit(1)).cast("int").alias("schema_version"),
        F.coalesce(text("mutation_policy"), F.lit("immutable")).alias("mutation_policy"), text("site_id").alias("site_id"), F.upper(text("country")).alias("country"),
        F.coalesce(text("dataset"), F.lit(spec.name)).alias("dataset"), text("source_id").alias("source_id"), F.coalesce(text("scope_type"), F.lit("global")).alias("scope_type"),
        text("scope_id").alias("scope_id"), F.coalesce(text("identity_scope_type"), text("scope_type"), F.lit("global")).alias("_it"),
        F.when(text("identity_scope_type").isNotNull(), text("identity_scope_id")).otherwise(text("scope_id")).alias("_ii"),
        text("instrument_id").alias("instrument_id"), time("event_time").alias("event_time"), time("updated_at").alias("updated_at"), time("crawled_at").alias("crawled_at"),
        *[text(c).alias(c) for c in ("title", "content", "author_id", "author_name", "source_url")],
        (sorted_json(F.col("payload")) if "payload" in df.columns else text("payload_json")).alias("payload_json"), relations_json(relations).alias("relations_json"), ident.relation_text(relations).alias("_rel"),
    )


def record_time(df: DataFrame, name: str) -> Column:
    """A time as it is, or ISO text: with Z, an offset or none (UTC). Other text is an error, not a missing time."""
    return iso_time(F.col(name)) if df.schema[name].dataType.typeName() == "string" else F.col(name).cast("timestamp")


def problems(df: DataFrame) -> Column:
    """Why a row is no record; empty if it is one."""
    said = [F.when(F.col(c).isNull(), F.lit(f"{c} is required")) for c in ("site_id", "country", "dataset", "source_id", "crawled_at")]
    said.append(F.when(F.col("schema_version") < 1, F.lit("schema_version must be 1 or more")))
    said.append(F.when(~F.col("mutation_policy").isin("immutable", "latest", "versioned"), F.lit("unknown mutation_policy")))
    return F.array_compact(F.array(*said))


def identified(own: DataFrame) -> DataFrame:
    uid = ident.record_uid(F.col("site_id"), F.col("dataset"), F.col("_it"), F.col("_ii"), F.col("source_id"))
    names = ["site_id", "dataset", "source_id", "instrument_id", "event_time", "updated_at", "title", "content", "author_id", "author_name", "source_url", "payload_json"]
    version = ident.version_hash(scope_type=F.col("_it"), scope_id=F.col("_ii"), relation_text=F.col("_rel"), **{n: F.col(n) for n in names})
    # Without a payload or relations a record has empty ones; its version is that of none.
    bare = {"payload_json": F.coalesce("payload_json", F.lit("{}")), "relations_json": F.coalesce("relations_json", F.lit("[]"))}
    return own.withColumns({"record_uid": uid, "version_hash": version}).withColumns(bare).select(*COLUMNS)


def sorted_json(payload: Column) -> Column:
    """A map of strings as JSON with sorted keys and its nulls."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(payload))), {"ignoreNullFields": "false"})


def relations_json(relations: Column) -> Column:
    parts = F.transform(relations, lambda r: F.struct(r["confidence"].alias("confidence"), r["instrument_id"].alias("instrument_id"), F.coalesce(r["relation_type"], F.lit("related")).alias("relation_type")))
    return F.to_json(parts, {"ignoreNullFields": "false"})


def partitioned(records: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Records with partition_date, bucket and the lake's path columns."""
    date = ident.partition_date(ident.partition_time(spec, F.col("event_time"), F.col("updated_at"), F.col("crawled_at")), spec.granularity)
    bucket = ident.bucket_name(ident.stable_bucket(ident.bucket_key(F.col("instrument_id"), F.col("scope_id"), F.col("source_id")), spec.buckets), spec.buckets)
    out = records.withColumns({"partition_date": date, "bucket": bucket})
    return out.withColumns({
        "site": ident.safe_value(F.col("site_id")), "country_code": ident.safe_value(F.col("country")), "dataset_name": ident.safe_value(F.col("dataset")),
        "year": F.date_format("partition_date", "yyyy"), "month": F.date_format("partition_date", "MM"), "day": F.date_format("partition_date", "dd"),
    })


def write_lake(records: DataFrame, spec: DatasetSpec, root: str, max_records: int = 500_000, mode: str = "append") -> None:
    """One shuffle brings a partition's rows together, so it gets few files; large ones are cut at max_records. A
    partition over the advisory size (a day of a hot bucket, a year of filings) is split over several tasks."""
    rows = partitioned(records, spec).hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "event_time", "record_uid")
    rows.select(*COLUMNS, *PARTITIONS).write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_records).partitionBy(*PARTITIONS).parquet(root)


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """All records with their path columns, the latter as text whatever they look like. The schema is given, so no
    file is opened to find it."""
    return spark.read.schema(lake_schema()).parquet(root)


def lake_schema() -> T.StructType:
    return T.StructType([*RECORD.fields, *[T.StructField(c, T.StringType()) for c in PARTITIONS]])


def files_of(records: DataFrame, spec: DatasetSpec) -> DataFrame:
    """A catalog row for each file that `records` (read from Parquet) comes from."""
    meta = records.select("*", fs.decoded(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
    date = ident.partition_date(ident.partition_time(spec, F.col("event_time"), F.col("updated_at"), F.col("crawled_at")), spec.granularity)
    bucket = ident.bucket_name(ident.stable_bucket(ident.bucket_key(F.col("instrument_id"), F.col("scope_id"), F.col("source_id")), spec.buckets), spec.buckets)
    out = meta.groupBy("file_path").agg(
        F.first("site_id").alias("site_id"), F.first("country").alias("country"), F.first("dataset").alias("dataset"), F.min(date).alias("partition_date"), F.min(bucket).alias("bucket"),
        F.count(F.lit(1)).alias("row_count"), F.first("file_size").alias("file_size"), F.min("event_time").alias("min_event_time"), F.max("event_time").alias("max_event_time"),
        F.min("schema_version").alias("schema_version"), F.count_distinct("schema_version").alias("_versions"),
    )
    one = F.when(F.col("_versions") > 1, F.raise_error(F.lit("a file mixes schema versions")).cast("int")).otherwise(F.col("schema_version"))
    return out.withColumn("schema_version", one).drop("_versions")


def paths_of(read: DataFrame) -> list[str]:
    """The files that a DataFrame reads, as they are written."""
    return [unquote(p) for p in read.inputFiles()]


def checksums(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_path, sha256, file_size) of whole files."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select(F.col("path").alias("file_path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("file_size"))


def with_checksums(spark: SparkSession, files: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Catalog rows with the sha256 of what the files hold, read by the executors."""
    sums = checksums(spark, paths).select(fs.plain_path(F.col("file_path")).alias("_p"), "sha256")
    return files.drop("sha256").withColumn("_p", fs.plain_path(F.col("file_path"))).join(sums, "_p").drop("_p")


def checked_size(read: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of files whose size is the catalog's. Another size, or a file that the catalog doesn't have, is an error."""
    sizes = files.select(fs.plain_path(F.coalesce("remote_path", "file_path") if "remote_path" in files.columns else F.col("file_path")).alias("_path"), F.col("file_size").alias("_size"))
    met = read.withColumns({"_p": fs.plain_path(fs.decoded(F.col("_metadata.file_path"))), "_s": F.col("_metadata.file_size")}).join(sizes, F.col("_p") == F.col("_path"), "left")
    fail = lambda why: F.raise_error(F.concat(F.lit(f"{why}: "), F.col("_p"))).cast("boolean")
    ok = F.when(F.col("_path").isNull(), fail("not in the catalog")).when(F.col("_s") == F.col("_size"), F.lit(True)).otherwise(fail("size differs from the catalog"))
    return met.where(ok).drop("_p", "_s", "_path", "_size")


def index_of(records: DataFrame) -> DataFrame:
    return records.select("record_uid", "version_hash")


def write_index(records: DataFrame, path: str) -> None:
    index_of(records).write.mode("overwrite").json(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar's pairs; blank lines are skipped, a bad line or entry is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    pair = F.from_json("value", STATE, {"mode": "FAILFAST"})
    out = lines.select(pair.alias("p")).select("p.*")
    need = lambda c: F.coalesce(c, F.raise_error(F.lit(f"index entry lacks {c}")).cast("string")).alias(c)
    return out.select(need("record_uid"), need("version_hash"))


def read_state(spark: SparkSession, path: str, schema) -> DataFrame:
    """A state table; one that was never written is empty."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def read_manifests(spark: SparkSession, path: str, schema) -> DataFrame:
    """One JSON file each; a bad one fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def load_checkpoint(scopes: DataFrame, checkpoints: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each scope's state; without a checkpoint it is an empty object."""
    return scopes.join(checkpoints.select(*key, "state"), list(key), "left").withColumn("state", F.coalesce("state", F.lit("{}")))


def saved_checkpoint(checkpoints: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New states replace old ones."""
    return checkpoints.join(new.select(*key), list(key), "left_anti").unionByName(new)


def store_checkpoints(spark: SparkSession, root: str, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Saves new states as the next version of the table at root and returns it."""
    old = versions.load(spark, root, new.schema)
    versions.save(saved_checkpoint(old, new, key), root)
    return versions.load(spark, root, new.schema)


def read_instruments(spark: SparkSession, path: str) -> DataFrame:
    """(pos, instrument_id) of a file with one id a line, whatever the ids look like; a file without any is an error."""
    out = read_universe(spark, path, strict=False)
    if out.isEmpty():
        raise ValueError(f"no instrument in {path}")
    return out


def read_universe(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(pos, instrument_id): the lines that aren't comments, each once, in order. strict: an id that isn't canonical,
    or another number than the '# metadata:' header says, is an error."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))
    lines = lines.select("pos", F.trim("line").alias("line"))
    body = lines.where((F.col("line") != "") & ~F.col("line").startswith("#")).withColumnRenamed("line", "instrument_id")
    out = ordered_distinct(body, "instrument_id", "pos")
    if strict:
        head = lines.where(F.col("line").startswith("# metadata:")).select(F.get_json_object(F.substring_index("line", "metadata:", -1), "$.count").cast("int").alias("n"))
        want, have = head.first(), out.count()
        if want and want["n"] is not None and want["n"] != have:
            raise ValueError(f"the header says {want['n']} instruments, the file has {have}")
        ok = F.when(is_canonical(F.col("instrument_id")), F.col("instrument_id")).otherwise(F.raise_error(F.concat(F.lit("not canonical: "), "instrument_id")).cast("string"))
        out = out.withColumn("instrument_id", ok)
    return out


def write_universe(universe: DataFrame, path: str) -> None:
    """One id a line after a header with their number. A universe is a list of instruments, not of records."""
    head = universe.agg(F.concat(F.lit('# metadata: {"count": '), F.count(F.lit(1)).cast("string"), F.lit("}")).alias("value")).select(F.lit(-1).alias("pos"), "value")
    body = universe.select("pos", F.col("instrument_id").alias("value"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("pos").select("value").write.mode("overwrite").text(path)


def ordered_distinct(df: DataFrame, value: str, pos: str) -> DataFrame:
    """Each value once, at its first place."""
    return df.where(F.trim(value) != "").groupBy(F.trim(value).alias(value)).agg(F.min(pos).alias(pos)).select(pos, value)


def prefix(universe: DataFrame, n: int, strict: bool = True) -> DataFrame:
    """The first n by pos; a shorter universe is an error."""
    out = universe.orderBy("pos").limit(n)
    if strict and out.count() < n:
        raise ValueError(f"the universe has fewer than {n} instruments")
    return out


def page(universe: DataFrame, offset: int = 0, limit: int | None = None) -> DataFrame:
    out = universe.orderBy("pos").offset(offset)
    return out if limit is None else out.limit(limit)


def csv_universe(spark: SparkSession, path: str, column: str, canonical_of) -> DataFrame:
    """Canonical ids of a CSV column in the file's order, each once."""
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path).withColumn("pos", F.monotonically_increasing_id())
    name = next(c for c in rows.columns if c.lstrip("﻿") == column)
    return ordered_distinct(rows.select("pos", canonical_of(F.col(f"`{name}`")).alias("instrument_id")), "instrument_id", "pos")


def export(df: DataFrame, path: str) -> None:
    """By the path's ending: JSON lines, or Parquet with snappy; nothing is written for Parquet without rows."""
    if path.endswith(".jsonl"):
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    elif path.endswith(".parquet"):
        if not df.isEmpty():
            df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown export format: {path}")


def existing_ids(spark: SparkSession, path: str, column: str = "news_id") -> DataFrame:
    """The ids in JSON lines; bad lines are ignored."""
    return spark.read.schema(f"{column} string").option("mode", "DROPMALFORMED").json(path).where(F.col(column).isNotNull()).distinct()


def attachments(spark: SparkSession, paths: Sequence[str], most: int = 100 << 20) -> DataFrame:
    """(path, sha256, size, stored_path, problem): where each file belongs by its content; equal contents are one. Of a
    file over `most` bytes the content isn't read, so it has a problem and no sha256. Spark doesn't list files
    without a byte."""
    listed = spark.read.format("binaryFile").load(list(paths))
    large = listed.where(F.col("length") > most).select("path", F.lit(None).cast("string").alias("sha256"), F.col("length").alias("size"), F.lit("too large").alias("problem"))
    sha, is_pdf = F.sha2("content", 256), F.substring("content", 1, 5) == F.lit(b"%PDF-")
    bad = F.when(~is_pdf, "not a PDF")
    out = listed.where(F.col("length") <= most).select("path", sha.alias("sha256"), F.col("length").alias("size"), bad.alias("problem")).unionByName(large)
    out = out.withColumn("stored_path", F.when(F.col("problem").isNull(), F.concat_ws("/", F.substring("sha256", 1, 2), F.concat("sha256", F.lit(".pdf")))))
    first = out.groupBy("sha256").agg(F.min("path").alias("_first"))
    return out.join(first, "sha256", "left").withColumn("is_first", F.col("problem").isNull() & (F.col("path") == F.col("_first"))).drop("_first")


def store_attachments(spark: SparkSession, paths: Sequence[str], root: str, most: int = 100 << 20) -> DataFrame:
    """Copies the first file of each content to root/stored_path, unless it is there with its size, and returns
    attachments() with `status`: stored, present, same (as another one) or rejected."""
    found = attachments(spark, paths, most)
    todo = [(r["path"], f"{root}/{r['stored_path']}", r["size"]) for r in found.where("is_first").select("path", "stored_path", "size").collect()]
    done = fs.copied(spark, todo)
    status = spark.createDataFrame([(s, k) for (s, _, _), k in zip(todo, done, strict=True)], "path string, _status string")
    told = F.when(F.col("problem").isNotNull(), "rejected").when(F.col("is_first"), F.col("_status")).otherwise("same")
    return found.join(status, "path", "left").withColumn("status", told).drop("_status")


def union_of(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows; a column that a part lacks is null."""
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
