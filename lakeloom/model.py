"""Record schema, dataset policies and catalog schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, not required) for n, t, required in fields])


_S, _TS, _L, _I = T.StringType(), T.TimestampType(), T.LongType(), T.IntegerType()

#: The 21 columns of every dataset; True: never null.
RECORD = _struct(
    ("schema_version", _I, True), ("record_uid", _S, True), ("version_hash", _S, True), ("mutation_policy", _S, True),
    ("site_id", _S, True), ("country", _S, True), ("dataset", _S, True), ("source_id", _S, True), ("scope_type", _S, True),
    ("scope_id", _S, False), ("instrument_id", _S, False), ("event_time", _TS, False), ("updated_at", _TS, False),
    ("crawled_at", _TS, True), ("title", _S, False), ("content", _S, False), ("author_id", _S, False),
    ("author_name", _S, False), ("source_url", _S, False), ("payload_json", _S, False), ("relations_json", _S, False),
)
COLUMNS = RECORD.fieldNames()

#: One row of the catalog stands for one Parquet file.
DATA_FILE = _struct(
    ("id", _L, True), ("site_id", _S, True), ("country", _S, True), ("dataset", _S, True), ("partition_date", T.DateType(), True),
    ("bucket", _S, True), ("file_path", _S, True), ("sha256", _S, True), ("row_count", _L, True), ("file_size", _L, True),
    ("min_event_time", _TS, False), ("max_event_time", _TS, False), ("schema_version", _I, True), ("storage_status", _S, True),
    ("lifecycle_status", _S, True), ("remote_path", _S, False),
)
STATE = _struct(("record_uid", _S, True), ("version_hash", _S, True))

POLICIES = ("immutable", "latest", "versioned")


@dataclass(frozen=True)
class DatasetSpec:
    """The policy of a dataset."""

    name: str
    mutation_policy: str = "versioned"
    partition_time: str = "event_time"
    default_scope: str = "global"
    requires_instrument: bool = False
    many_instruments: bool = False
    may_lack_event_time: bool = True
    relation_dataset: bool = False
    granularity: str = "day"
    buckets: int = 256
    legacy_buckets: tuple[int, ...] = ()

    @property
    def relation_aware(self) -> bool:
        return self.name in ("financial_report", "news_article", "research_report")


_link = {"mutation_policy": "immutable", "partition_time": "crawled_at", "default_scope": "instrument", "requires_instrument": True, "relation_dataset": True}
_yearly = {"granularity": "year", "buckets": 1, "legacy_buckets": (256,)}
DATASETS: dict[str, DatasetSpec] = {
    s.name: s
    for s in (
        DatasetSpec("news_article", many_instruments=True),
        DatasetSpec("news_instrument", **_link),
        DatasetSpec("forum_post", default_scope="instrument"),
        DatasetSpec("comment", default_scope="record"),
        DatasetSpec("research_report", many_instruments=True),
        DatasetSpec("research_instrument", **_link),
        DatasetSpec("financial_report", default_scope="instrument", requires_instrument=True, many_instruments=True, **_yearly),
        DatasetSpec("financial_report_instrument", **_link, **_yearly),
        DatasetSpec("author_profile", partition_time="updated_at", default_scope="author", many_instruments=True),
        DatasetSpec("author_post", default_scope="author", many_instruments=True),
        DatasetSpec("holding_snapshot", mutation_policy="immutable", default_scope="author", many_instruments=True, may_lack_event_time=False),
        DatasetSpec("holding_position", mutation_policy="immutable", default_scope="instrument", requires_instrument=True, may_lack_event_time=False),
        DatasetSpec("instrument", partition_time="crawled_at", default_scope="instrument", requires_instrument=True),
        DatasetSpec("instrument_relation", default_scope="instrument", requires_instrument=True, many_instruments=True, relation_dataset=True),
        DatasetSpec("attachment", mutation_policy="immutable", partition_time="crawled_at", default_scope="record", many_instruments=True),
    )
}


def spec_of(dataset: str) -> DatasetSpec:
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset: {dataset}")
    return DATASETS[dataset]


class SchemaRegistry:
    """dataset -> (spec, schema, version); a dataset is registered once unless replaced."""

    def __init__(self) -> None:
        self._known: dict[str, tuple[DatasetSpec, T.StructType, int]] = {n: (s, RECORD, 1) for n, s in DATASETS.items()}

    def register(self, spec: DatasetSpec, schema: T.StructType = RECORD, version: int = 1, replace: bool = False) -> None:
        if spec.name in self._known and not replace:
            raise ValueError(f"already registered: {spec.name}")
        self._known[spec.name] = (spec, schema, version)

    def get(self, dataset: str) -> tuple[DatasetSpec, T.StructType, int]:
        if dataset not in self._known:
            raise ValueError(f"unknown dataset: {dataset}")
        return self._known[dataset]

    def names(self) -> list[str]:
        return sorted(self._known)
