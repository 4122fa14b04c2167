"""Record identity, buckets and partition columns as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import DatasetSpec
from .text import optional, strip

SEPARATOR = "\x1f"


def stable_sha256(*parts: Column) -> Column:
    """The parts are stripped, null as '', and joined by the unit separator."""
    return F.sha2(F.concat_ws(SEPARATOR, *[strip(p) for p in parts]), 256)


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def record_uid(site: Column, dataset: Column, scope_type: Column, scope_id: Column, source_id: Column) -> Column:
    return stable_sha256(site, dataset, scope_type, scope_id, source_id)


def relation_text(relations: Column) -> Column:
    """instrument:type:confidence of each relation, sorted, between bars."""
    line = lambda r: F.concat_ws(":", r["instrument_id"], r["relation_type"], F.coalesce(r["confidence"].cast("string"), F.lit("None")))
    return F.array_join(F.array_sort(F.transform(F.coalesce(relations, F.array().cast("array<struct<instrument_id:string,relation_type:string,confidence:double>>")), line)), "|")


def version_hash(**c: Column) -> Column:
    """Of all that makes a version; the crawl time isn't part of it. The payload enters as canonical (sorted) JSON."""
    order = ["site_id", "dataset", "source_id", "scope_type", "scope_id", "instrument_id", "event_time", "updated_at", "title", "content", "author_id", "author_name", "source_url", "relation_text", "payload_json"]
    null = F.lit(None).cast("string")
    return stable_sha256(*[iso_seconds(c[n]) if n in ("event_time", "updated_at") and n in c else c.get(n, null) for n in order])


def stable_bucket(value: Column, n: int) -> Column:
    """The first 8 bytes of the SHA-1 of the stripped value ('_' if blank), as an unsigned number, modulo n."""
    text = F.coalesce(optional(value), F.lit("_"))
    return (F.conv(F.substring(F.sha1(text.cast("binary")), 1, 16), 16, 10).cast("decimal(20,0)") % n).cast("int")


def bucket_name(bucket: Column, n: int) -> Column:
    """Lower-case hex, two digits or as many as n-1 has."""
    return F.lpad(F.lower(F.hex(bucket)), max(2, len(f"{n - 1:x}")), "0")


def instrument_bucket(instrument: Column, n: int) -> Column:
    """The bucket's name; null for a blank instrument."""
    return F.when(optional(instrument).isNotNull(), bucket_name(stable_bucket(instrument, n), n))


def safe_value(c: Column) -> Column:
    """A path component: other than letters, digits and -_.: becomes _, and so does every '..'; '' is _."""
    text = F.regexp_replace(F.regexp_replace(strip(c), r"[^\p{L}\p{N}_.:-]", "_"), r"\.\.", "_")
    return F.when(text == "", F.lit("_")).otherwise(text)


def partition_time(spec: DatasetSpec, event_time: Column, updated_at: Column, crawled_at: Column) -> Column:
    """The dataset's time, else the crawl time; an error where the dataset must have an event time."""
    own = {"event_time": event_time, "updated_at": updated_at, "crawled_at": crawled_at}[spec.partition_time]
    if not spec.may_lack_event_time:
        return F.coalesce(own, F.raise_error(F.lit(f"{spec.name} requires event_time")).cast("timestamp"))
    return F.coalesce(own, crawled_at)


def partition_date(ts: Column, granularity: str) -> Column:
    return ts.cast("date") if granularity == "day" else F.trunc(ts.cast("date"), granularity)


def bucket_key(instrument: Column, scope_id: Column, source_id: Column) -> Column:
    return F.coalesce(optional(instrument), optional(scope_id), optional(source_id))


def partition_path(site: Column, country: Column, dataset: Column, date: Column, bucket: Column) -> Column:
    pairs = [("site", safe_value(site)), ("country", safe_value(country)), ("dataset", safe_value(dataset)), ("year", F.date_format(date, "yyyy")), ("month", F.date_format(date, "MM")), ("day", F.date_format(date, "dd")), ("bucket", bucket)]
    return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), v) for k, v in pairs])


def parsed_path(path: Column) -> Column:
    """The k=v parts of a path as a map."""
    parts = F.filter(F.split(path, "/"), lambda p: p.contains("="))
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.regexp_replace(p, "^[^=]*=", "").alias("v"))))


#: The parts that a path of the lake has.
PATH_KEYS = ["site", "country", "dataset", "year", "month", "day", "bucket"]


def missing_keys(path: Column) -> Column:
    """The required parts that a path lacks."""
    return F.array_except(F.array(*[F.lit(k) for k in PATH_KEYS]), F.map_keys(parsed_path(path)))


def scope_token(site: Column, dataset: Column, kind: Column, key: Column) -> Column:
    return F.concat_ws("|", site, dataset, kind, key)


def estimated_bytes(*columns: Column) -> Column:
    """UTF-8 length of the row as compact JSON, with its nulls."""
    return F.octet_length(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def content_id(*parts: Column) -> Column:
    """SHA-256 of the parts between bars."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
