"""Records and the instruments that they name; details and attachments of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RELATION = "array<struct<instrument_id:string,relation_type:string,confidence:double>>"


def bridge(records: DataFrame) -> DataFrame:
    """(record_uid, instrument_id, relation_type, confidence): one row for each instrument that a record names."""
    each = records.select("record_uid", F.explode(F.from_json("relations_json", RELATION)).alias("r"))
    named = each.where(F.trim("r.instrument_id") != "")
    return named.groupBy("record_uid", F.col("r.instrument_id").alias("instrument_id"), F.coalesce("r.relation_type", F.lit("related")).alias("relation_type")).agg(F.max("r.confidence").alias("confidence"))


def counted_by(links: DataFrame, instruments: DataFrame, kind: str) -> DataFrame:
    """Per kind of instrument: n_records (different ones) and n_links. links: record_uid, instrument_id."""
    met = links.join(instruments.select("instrument_id", kind), "instrument_id")
    return met.groupBy(kind).agg(F.count_distinct("record_uid").alias("n_records"), F.count(F.lit(1)).alias("n_links"))


def fanned_out(reports: DataFrame, ids: str = "instrument_ids") -> DataFrame:
    """One row for each non-blank instrument of a report."""
    out = reports.withColumn("instrument_id", F.explode(ids)).drop(ids)
    return out.where(F.trim("instrument_id") != "")


def with_detail(items: DataFrame, details: DataFrame, key: Sequence[str]) -> DataFrame:
    """List items with their detail; its value wins only where there is one."""
    shared = [c for c in items.columns if c in details.columns and c not in key]
    added = [c for c in details.columns if c not in items.columns]
    own = details.select(*key, *[F.col(c).alias(f"_{c}") for c in shared], *added)
    met = items.join(own, list(key), "left")
    return met.select(*[F.coalesce(f"_{c}", c).alias(c) if c in shared else F.col(c) for c in items.columns], *added)


def attached(reports: DataFrame, attachments: DataFrame) -> DataFrame:
    return reports.join(attachments.withColumnRenamed("parent_record_uid", "record_uid"), "record_uid")


def first_of_types(results: DataFrame, key: str | Sequence[str], types: Sequence[str], kind: str = "report_type") -> DataFrame:
    """The results of several searches as one; of equal keys (a column or several) the one of the first type stays."""
    rank = F.array_position(F.array(*[F.lit(t) for t in types]), F.col(kind))
    best = results.groupBy(*([key] if isinstance(key, str) else key)).agg(F.min_by(F.struct(*results.columns), rank).alias("_r"))
    return best.select("_r.*")


def last_per_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and new rows as one; of equal keys the new one stays."""
    both = old.withColumn("_at", F.lit(0)).unionByName(new.withColumn("_at", F.lit(1)))
    return both.groupBy(key).agg(F.max_by(F.struct(*old.columns), "_at").alias("_r")).select("_r.*")


def last_at_first_place(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """Each key once: its last row, at the place of its first."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), pos).alias("_r"), F.min(pos).alias("_first")).select("_r.*", "_first").drop(pos).withColumnRenamed("_first", pos)


def parted(rows: DataFrame, ok: str) -> tuple[DataFrame, DataFrame]:
    """(rows that succeeded, rows still pending)."""
    good = F.coalesce(F.col(ok), F.lit(False))
    return rows.where(good), rows.where(~good)


def single_instrument(records: DataFrame) -> DataFrame:
    """instrument_id only where a record has exactly one relation."""
    rel = F.from_json("relations_json", RELATION)
    return records.withColumn("instrument_id", F.when(F.size(rel) == 1, rel[0]["instrument_id"]))


def delta(counters: DataFrame, key: Sequence[str], order: str, value: str) -> DataFrame:
    """counters with `delta`: the value less that of the row before."""
    before = F.lag(value).over(Window.partitionBy(*key).orderBy(order))
    return counters.withColumn("delta", F.col(value) - F.coalesce(before, F.lit(0)))
