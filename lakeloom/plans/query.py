"""QuerySpec -> DataFrame: a typed query over the record lake, with partition and bucket pruning.

Dates are local days of a time zone and become half-open UTC bounds; the partition dates that can hold such times are
derived from them, so Catalyst prunes directories, and the bounds themselves go down to the Parquet scan. Filters come
before the projection, so a projected-away instrument column still filters.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import time
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import COLUMNS, DATASETS, RECORD, DatasetSpec
from ..sources import catalog
from ..sources.lake import checked_size, lake_schema

DAY = dt.timedelta(days=1)


@dataclass(frozen=True)
class QuerySpec:
    site_id: str
    dataset: str
    country: str | None = None
    instrument_id: str | None = None
    instrument_ids: Sequence[str] = ()
    record_uid: str | None = None
    start_date: str | dt.date | None = None
    end_date: str | dt.date | None = None
    timezone: str = "UTC"
    columns: Sequence[str] | None = None
    #: Prune datasets that are partitioned by another time than event_time by event dates too (which loses rows).
    strict_dates: bool = False


@dataclass(frozen=True)
class NormalQuery:
    spec: DatasetSpec
    site_id: str
    country: str | None
    instruments: tuple[str, ...]
    record_uid: str | None
    start: dt.datetime | None
    end: dt.datetime | None
    columns: tuple[str, ...]
    buckets: tuple[str, ...] | None
    dates: tuple[dt.date, dt.date] | None


@dataclass
class QueryStats:
    """What a query did: counts, and seconds of its parts."""

    catalog_lookups: int = 0
    catalog_files: int = 0
    candidate_rows: int = 0
    parquet_files_read: int = 0
    rows_read: int = 0
    rows_returned: int = 0
    batches: int = 0
    largest_batch_bytes: int = 0
    stopped_early: bool = False
    catalog_seconds: float = 0.0
    read_seconds: float = 0.0
    total_seconds: float = 0.0

    def row(self) -> dict:
        return asdict(self)


def lookups_hold(stats: QueryStats, n_instruments: int) -> None:
    """The catalog must not be asked for each instrument."""
    if n_instruments > 1 and stats.catalog_lookups >= n_instruments:
        raise AssertionError(f"{stats.catalog_lookups} catalog lookups for {n_instruments} instruments")


def memory_holds(stats: QueryStats, batch_size: int, row_bytes: int) -> bool:
    """Whether no batch was larger than its rows may be."""
    return stats.largest_batch_bytes <= batch_size * row_bytes


def required(value: str, name: str) -> str:
    if not (text := str(value or "").strip()):
        raise ValueError(f"{name} is required")
    return text


def day(value: str | dt.date | None) -> dt.date | None:
    if value is None or isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value
    return value.date() if isinstance(value, dt.datetime) else dt.date.fromisoformat(str(value).strip())


def local_midnight(d: dt.date, zone: str) -> dt.datetime:
    try:
        tz = ZoneInfo(zone)
    except Exception as e:
        raise ValueError(f"unknown time zone: {zone}") from e
    return dt.datetime(d.year, d.month, d.day, tzinfo=tz).astimezone(dt.timezone.utc)


def normal_instruments(one: str | None, many: Sequence[str]) -> tuple[str, ...]:
    """All of them stripped, each once, in order."""
    return tuple(dict.fromkeys(t for v in ([one] if one else []) + list(many) if (t := str(v).strip())))


def normal_columns(columns: Sequence[str] | None) -> tuple[str, ...]:
    """All 21 by default; each once, the first place counts."""
    if columns is None:
        return tuple(COLUMNS)
    out = tuple(dict.fromkeys(str(c).strip() for c in columns))
    if not out or "" in out:
        raise ValueError("columns must not be empty")
    if unknown := [c for c in out if c not in COLUMNS]:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    return out


def bucket_label(instrument: str, n: int) -> str:
    value = instrument.strip() or "_"
    number = int.from_bytes(hashlib.sha1(value.encode()).digest()[:8], "big") % n
    return format(number, "x").zfill(max(2, len(f"{n - 1:x}")))


def normalised(q: QuerySpec) -> NormalQuery:
    site, dataset = required(q.site_id, "site_id"), required(q.dataset, "dataset")
    spec = DATASETS.get(dataset) or replace(DATASETS["news_article"], name=dataset)
    first, last = day(q.start_date), day(q.end_date)
    if first and last and first > last:
        raise ValueError("start_date is after end_date")
    zone = str(q.timezone or "UTC").strip()
    start = local_midnight(first, zone) if first else None
    end = local_midnight(last + DAY, zone) if last else None
    local_midnight(dt.date(2000, 1, 1), zone)
    instruments = normal_instruments(q.instrument_id, q.instrument_ids)
    # Relations may name an instrument whose bucket isn't that of the row, so relation-aware datasets aren't pruned.
    buckets = None
    if instruments and not spec.relation_aware:
        buckets = tuple(sorted({bucket_label(i, n) for i in instruments for n in (spec.buckets, *spec.legacy_buckets)}))
    prunable = spec.partition_time == "event_time" or q.strict_dates
    return NormalQuery(spec, site, q.country.strip().upper() if q.country and q.country.strip() else None, instruments, q.record_uid, start, end, normal_columns(q.columns), buckets, partition_dates(start, end, spec.granularity) if prunable else None)


def partition_dates(start: dt.datetime | None, end: dt.datetime | None, granularity: str) -> tuple[dt.date, dt.date] | None:
    """The inclusive range of UTC partition dates of a half-open range of times; none unless both ends are known."""
    if not start or not end:
        return None
    first, last = start.date(), (end - dt.timedelta(microseconds=1)).date()
    if granularity in ("month", "year"):
        first = first.replace(day=1)
    if granularity == "year":
        first = first.replace(month=1)
    return first, last


def related(instruments: Sequence[str], own: Column | None = None, relations: Column | None = None) -> Column:
    """The row's instrument, or one of its relations, is among these. Relations that are no JSON list of objects match nothing."""
    own = F.col("instrument_id") if own is None else own
    relations = F.col("relations_json") if relations is None else relations
    named = F.exists(F.from_json(relations, "array<string>"), lambda r: F.coalesce(F.get_json_object(r, "$.instrument_id").isin(list(instruments)), F.lit(False)))
    return F.coalesce(own.isin(list(instruments)), F.lit(False)) | F.coalesce(F.trim(relations).startswith("[") & named, F.lit(False))


def predicate(q: NormalQuery) -> Column:
    out = F.lit(True)
    if q.record_uid:
        out = out & (F.col("record_uid") == q.record_uid)
    if q.instruments:
        out = out & (related(q.instruments) if q.spec.relation_aware else F.col("instrument_id").isin(list(q.instruments)))
    if q.start:
        out = out & (F.col("event_time") >= F.lit(q.start))
    if q.end:
        out = out & (F.col("event_time") < F.lit(q.end))
    return out


def ordered(df: DataFrame) -> DataFrame:
    """By event_time, then record_uid, nulls last, as far as they are projected."""
    if "event_time" not in df.columns:
        return df
    return df.orderBy(F.asc_nulls_last("event_time"), *([F.asc_nulls_last("record_uid")] if "record_uid" in df.columns else []))


def on_lake(lake: DataFrame, spec: QuerySpec) -> DataFrame:
    """The query on a directory lake (sources.lake.read_lake): pruned by its path columns."""
    q = normalised(spec)
    out = lake.where((F.col("site") == q.site_id) & (F.col("dataset_name") == q.spec.name))
    if q.country:
        out = out.where(F.col("country_code") == q.country)
    if q.dates:
        path_date = F.concat_ws("-", "year", "month", "day")
        out = out.where(path_date.between(q.dates[0].isoformat(), q.dates[1].isoformat()))
    if q.buckets is not None:
        out = out.where(F.col("bucket").isin(list(q.buckets)))
    return ordered(out.where(predicate(q)).select(*q.columns))


def globs(root: str, q: NormalQuery) -> list[str]:
    """Patterns of the directories that may hold rows: by day for two months at most, else by month, and by bucket."""
    name = lambda v: v if v and re.fullmatch(r"[\w.:-]+", v) else "*"
    base = f"{root}/site={name(q.site_id)}/country_code={name(q.country)}/dataset_name={name(q.spec.name)}"
    buckets = "{" + ",".join(q.buckets) + "}" if q.buckets is not None else "*"
    if not q.dates:
        return [f"{base}/year=*/month=*/day=*/bucket={buckets}"]
    days = [q.dates[0] + i * DAY for i in range((q.dates[1] - q.dates[0]).days + 1)]
    which = [(f"{d:%Y}", f"{d:%m}", f"{d:%d}") for d in days] if len(days) <= 62 else sorted({(f"{d:%Y}", f"{d:%m}", "*") for d in days})
    return [f"{base}/year={y}/month={m}/day={d}/bucket={buckets}" for y, m, d in which]


def on_root(spark: SparkSession, root: str, spec: QuerySpec) -> DataFrame:
    """The query on a lake's folder. Only directories that may hold rows are listed, however many there are."""
    q = normalised(spec)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [str(s.getPath().toString()) for g in globs(root, q) for s in fs.globStatus(hadoop(g)) or ()]
    if not found:
        return spark.createDataFrame([], RECORD).select(*q.columns)
    return on_lake(spark.read.schema(lake_schema()).option("basePath", root).parquet(*found), spec)


def on_records(records: DataFrame, spec: QuerySpec) -> DataFrame:
    """The query on any DataFrame with the record columns."""
    q = normalised(spec)
    out = records.where((F.col("site_id") == q.site_id) & (F.col("dataset") == q.spec.name))
    if q.country:
        out = out.where(F.col("country") == q.country)
    return ordered(out.where(predicate(q)).select(*q.columns))


def candidates(files: DataFrame, q: NormalQuery) -> DataFrame:
    """The catalog's files that may hold rows; one listing however many instruments there are. Files whose times are
    known to miss the bounds are left out."""
    first, last = q.dates or (None, None)
    out = catalog.listing(files, q.site_id, q.spec.name, q.country, first, last, buckets=q.buckets)
    if q.start:
        out = out.where(F.col("max_event_time").isNull() | (F.col("max_event_time") >= F.lit(q.start)))
    if q.end:
        out = out.where(F.col("min_event_time").isNull() | (F.col("min_event_time") < F.lit(q.end)))
    return out


def on_catalog(spark: SparkSession, files: DataFrame, spec: QuerySpec, stats: QueryStats | None = None, check_size: bool = False) -> DataFrame:
    """The query on the files that the catalog lists. The schema is known, so no file is opened before it is read.
    check_size: a file of another size than the catalog's is an error."""
    q, began = normalised(spec), time.monotonic()
    listing = candidates(files, q)
    found = listing.select("file_path", "remote_path", "row_count").collect()
    if stats is not None:
        stats.catalog_lookups += 1
        stats.catalog_files = stats.parquet_files_read = len(found)
        stats.candidate_rows = stats.rows_read = sum(f["row_count"] for f in found)
        stats.catalog_seconds += time.monotonic() - began
    if not found:
        return spark.createDataFrame([], RECORD).select(*q.columns)
    rows = spark.read.schema(RECORD).parquet(*[f["remote_path"] or f["file_path"] for f in found])
    return ordered((checked_size(rows, listing) if check_size else rows).where(predicate(q)).select(*q.columns))


def iter_arrow(spark: SparkSession, files: DataFrame, spec: QuerySpec, batch_size: int = 65_536, max_rows: int | None = None, stats: QueryStats | None = None) -> Iterator[pa.RecordBatch]:
    """Arrow batches, file by file in catalog order; no file is opened once max_rows is reached. No order across files.
    The driver holds one file's rows that match."""
    if batch_size < 1 or max_rows is not None and max_rows < 1:
        raise ValueError("batch_size and max_rows must be at least 1")
    q, stats, began = normalised(spec), stats if stats is not None else QueryStats(), time.monotonic()
    left, found = max_rows, candidates(files, q).select("file_path", "remote_path", "row_count").collect()
    stats.catalog_lookups, stats.catalog_files, stats.candidate_rows = stats.catalog_lookups + 1, len(found), sum(f["row_count"] for f in found)
    stats.catalog_seconds += time.monotonic() - began
    for f in found:
        if left == 0:
            stats.stopped_early = True
            break
        at = time.monotonic()
        rows = spark.read.schema(RECORD).parquet(f["remote_path"] or f["file_path"]).where(predicate(q)).select(*q.columns)
        table = (rows if left is None else rows.limit(left)).toArrow()
        stats.parquet_files_read, stats.rows_read = stats.parquet_files_read + 1, stats.rows_read + f["row_count"]
        stats.read_seconds += time.monotonic() - at
        left = None if left is None else left - table.num_rows
        for batch in table.combine_chunks().to_batches(max_chunksize=batch_size):
            if batch.num_rows:
                stats.batches, stats.rows_returned = stats.batches + 1, stats.rows_returned + batch.num_rows
                stats.largest_batch_bytes = max(stats.largest_batch_bytes, batch.nbytes)
                yield batch
    stats.total_seconds += time.monotonic() - began


def iter_batches(spark: SparkSession, files: DataFrame, spec: QuerySpec, batch_size: int = 65_536, max_rows: int | None = None, stats: QueryStats | None = None) -> Iterator[list]:
    """iter_arrow() as lists of dictionaries."""
    for batch in iter_arrow(spark, files, spec, batch_size, max_rows, stats):
        yield batch.to_pylist()


def streamed(spark: SparkSession, files: DataFrame, spec: QuerySpec, max_rows: int, stats: QueryStats | None = None) -> DataFrame:
    """The first max_rows rows in catalog order, from as few files as it takes."""
    schema = T.StructType([RECORD[c] for c in normalised(spec).columns])
    got = list(iter_arrow(spark, files, spec, max_rows=max_rows, stats=stats))
    return spark.createDataFrame(pa.Table.from_batches(got), schema) if got else spark.createDataFrame([], schema)


def first_of_batch(batch: pa.RecordBatch, instruments: Sequence[str]) -> pa.RecordBatch:
    """The rows of an Arrow batch that name one of the instruments, themselves or by a relation."""
    wanted, keep = set(instruments), []
    for own, text in zip(batch.column("instrument_id").to_pylist(), batch.column("relations_json").to_pylist(), strict=True):
        try:
            named = json.loads(text or "[]")
        except ValueError:
            named = []
        keep.append(own in wanted or isinstance(named, list) and any(isinstance(r, dict) and r.get("instrument_id") in wanted for r in named))
    return batch.filter(pa.array(keep, pa.bool_()))


def printed(rows: DataFrame, limit: int = 20, as_json: bool = False) -> str:
    """Rows as text: JSON lines, or columns one below the other. The limit is for display only."""
    got = rows.limit(limit)
    if as_json:
        return "\n".join(got.toJSON().collect())
    return "\n".join(f"{i + 1}. " + " | ".join(f"{c}={r[c]}" for c in got.columns if r[c] is not None) for i, r in enumerate(got.collect()))


def asked_instruments(one: str | None = None, many: Sequence[str] = (), file_ids: Sequence[str] | None = None) -> tuple[str, ...]:
    """Instruments of a flag, a list and a file as one; a file without any is an error."""
    if file_ids is not None and not [i for i in file_ids if i.strip()]:
        raise ValueError("the instruments file is empty")
    return normal_instruments(one, [*many, *(file_ids or ())])
