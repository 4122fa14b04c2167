"""Progress of runs: per dataset, site and platform, and file sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def by_dataset(state: DataFrame) -> DataFrame:
    """state: site_id, dataset, total, durable, runtime_done, running, blocked, failed, and counters records, files, bytes, elapsed."""
    done = F.least("total", F.col("durable") + F.col("runtime_done"))
    out = state.withColumns({"completed": done, "remaining": F.greatest(F.col("total") - done, F.lit(0)), "percent": rules.percent(done, F.col("total"))})
    rate = lambda c: F.when(F.col("elapsed") > 0, c / F.col("elapsed")).otherwise(0.0)
    out = out.withColumns({"records_per_second": rate(F.col("records")), "files_per_minute": rate(F.col("files") * 60.0), "mb_per_second": rate(F.col("bytes") / (1 << 20))})
    status = rules.dataset_status(*[F.col(c) for c in ("total", "completed", "running", "runtime_done", "blocked", "failed")])
    return out.withColumn("status", status)


def rolled_up(datasets: DataFrame) -> DataFrame:
    """Sums by dataset, site and platform in one pass; the level says which."""
    level = F.when(F.grouping_id() == 3, "platform").when(F.grouping_id() == 1, "site").otherwise("dataset")
    out = datasets.rollup("site_id", "dataset").agg(
        level.alias("level"), F.sum("total").alias("total"), F.sum("completed").alias("completed"), F.sum("records").alias("records"),
        rules.group_status(F.col("status"), F.sum("total"), F.sum("completed")).alias("status"),
    )
    return out.withColumn("percent", rules.percent(F.col("completed"), F.col("total")))


def eta_seconds(datasets: DataFrame) -> DataFrame:
    per = F.when((F.col("completed") > 0) & (F.col("elapsed") > 0), F.col("elapsed") / F.col("completed"))
    return datasets.withColumn("eta_seconds", per * (F.col("total") - F.col("completed")))


def file_sizes(files: DataFrame) -> DataFrame:
    """One row: files, bytes, rows, least and greatest size."""
    zero = F.lit(0).cast("long")
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("file_size"), zero).alias("n_bytes"), F.coalesce(F.sum("row_count"), zero).alias("n_rows"), F.coalesce(F.min("file_size"), zero).alias("least_bytes"), F.coalesce(F.max("file_size"), zero).alias("most_bytes"))


def queue_gauges(samples: DataFrame) -> DataFrame:
    """samples: queue, at, size. The last size and the greatest."""
    return samples.groupBy("queue").agg(F.max_by("size", "at").alias("current"), F.max("size").alias("most"))


def status_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def activity(events: DataFrame) -> DataFrame:
    """Per dataset what was stored: events of kind `file` (with n_bytes) and `record`."""
    file = F.col("kind") == "file"
    return events.groupBy("dataset").agg(F.count_if(file).alias("n_files"), F.coalesce(F.sum(F.when(file, F.col("n_bytes"))), F.lit(0)).alias("n_bytes"), F.count_if(F.col("kind") == "record").alias("n_records"))


def run_manifest(state: DataFrame, run_id: str) -> DataFrame:
    """One row: the run, its datasets and the sums of their counters."""
    names = [c for c in ("total", "durable", "runtime_done", "running", "blocked", "failed", "records", "files", "bytes") if c in state.columns]
    return state.agg(F.lit(run_id).alias("run_id"), F.count(F.lit(1)).alias("datasets"), *[F.sum(c).alias(c) for c in names])


def write_manifest(state: DataFrame, run_id: str, path: str) -> None:
    """The manifest as JSON."""
    run_manifest(state, run_id).coalesce(1).write.mode("overwrite").json(path)
