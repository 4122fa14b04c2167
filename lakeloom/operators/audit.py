"""Audits: the catalog against storage, completeness of runs, recovery, and safe repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..sources import catalog


def catalog_issues(files: DataFrame, storage: DataFrame, checksum: bool = True) -> DataFrame:
    """(file_path, code) of each thing wrong. storage: path, size, sha256 of what is there."""
    there = storage.select(F.col("path").alias("_path"), F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    met = files.join(there, F.coalesce("remote_path", "file_path") == F.col("_path"), "left")
    uploaded, active = F.col("storage_status") == "uploaded", F.col("lifecycle_status") == "active"
    nameless = active & uploaded & (F.coalesce("remote_path", F.lit("")) == "")
    found = uploaded & ~nameless
    codes = [
        (active & ~uploaded, "lifecycle_inconsistent"), (nameless, "missing_remote_path"), (found & F.col("_path").isNull(), "remote_file_missing"),
        (found & (F.col("_size") != F.col("file_size")), "file_size_mismatch"),
    ]
    if checksum:
        codes.append((found & (F.col("_sha") != F.col("sha256")), "checksum_mismatch"))
    own = met.select("file_path", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in codes]))).alias("code"))
    described = files.groupBy("file_path").agg(F.count_distinct("sha256", "row_count", "file_size").alias("n")).where(F.col("n") > 1)
    return own.unionByName(described.select("file_path", F.lit("duplicate_conflicting_metadata").alias("code")))


def orphans(files: DataFrame, storage: DataFrame) -> DataFrame:
    """Stored paths that no catalog row names."""
    named = files.select(F.coalesce("remote_path", "file_path").alias("path"))
    return storage.join(named, "path", "left_anti").select("path", F.lit("warning").alias("severity"))


def completeness(expected: DataFrame, checkpoints: DataFrame, recovery: DataFrame) -> DataFrame:
    """Per dataset: expected and completed scopes, those missing, recovery pending and failed, complete or not.

    expected: dataset, n_expected (null: unknown). checkpoints: dataset, scope. recovery: dataset, stage."""
    done = checkpoints.groupBy("dataset").agg(F.count_distinct("scope").alias("n_completed"))
    open_ = recovery.groupBy("dataset").agg(F.count_if(~F.col("stage").isin("deleted", "failed")).alias("n_pending"), F.count_if(F.col("stage") == "failed").alias("n_failed"))
    out = expected.join(done, "dataset", "left").join(open_, "dataset", "left").na.fill(0, ["n_completed", "n_pending", "n_failed"])
    missing = F.greatest(F.coalesce("n_expected", F.lit(0)) - F.col("n_completed"), F.lit(0))
    return out.withColumn("n_missing", missing).withColumn("is_complete", (missing == 0) & (F.col("n_pending") == 0) & (F.col("n_failed") == 0))


def expected_scopes(datasets: DataFrame, n_instruments: int) -> DataFrame:
    """dataset, n_expected: one a stock for those by instrument, one for research, unknown otherwise."""
    by_stock = F.col("dataset").isin("forum_post", "news_instrument", "research_instrument", "instrument_relation")
    return datasets.select("dataset", F.when(by_stock, F.lit(n_instruments)).when(F.col("dataset") == "research_report", F.lit(1)).alias("n_expected"))


def month_counts(expected: DataFrame, states: DataFrame) -> DataFrame:
    """(status, n) over expected months; states: month, state (JSON)."""
    met = expected.join(states, "month", "left")
    return met.groupBy(rules.month_status(F.col("state")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def pending_manifests(manifests: DataFrame) -> DataFrame:
    return manifests.where(F.col("stage") != "deleted")


def of_scope(manifests: DataFrame, token: str) -> DataFrame:
    return manifests.where(F.array_contains("scope_tokens", token))


def resume_plan(scopes: DataFrame, checkpoints: DataFrame, recovery: DataFrame, blocked: DataFrame) -> DataFrame:
    """Each scope with its status; a scope that comes twice is an error. checkpoints: scope, complete. recovery: scope,
    terminal, retryable, pending. blocked: scope, reason."""
    twice = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate scope: "), "scope")).cast("string")).otherwise(F.col("scope"))
    once = scopes.groupBy("scope").agg(F.count(F.lit(1)).alias("_n")).select(twice.alias("scope"))
    met = once.join(checkpoints, "scope", "left").join(recovery, "scope", "left").join(blocked, "scope", "left")
    status = rules.resume_status(*[F.col(c) for c in ("reason", "terminal", "retryable", "pending", "complete")])
    return met.select("scope", status.alias("status"), rules.should_crawl(status).alias("should_crawl"))


def repaired_uploads(files: DataFrame, storage: DataFrame, dry_run: bool = True) -> tuple[DataFrame, DataFrame]:
    """(what can be repaired, the catalog after it): local active files whose remote copy has their size become uploaded."""
    there = storage.select(F.col("path").alias("remote_path"), F.col("size").alias("_size"), F.col("file_path"))
    fit = catalog.local_active(files).drop("remote_path").join(there, "file_path").where(F.col("_size") == F.col("file_size")).select("file_path", "remote_path")
    return fit, files if dry_run else catalog.mark_uploaded(files, fit)


def reconciled(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only the source ('missing') or only the target ('unexpected') has."""
    a, b = source.select(key).distinct(), target.select(key).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("missing")).unionByName(b.exceptAll(a).withColumn("side", F.lit("unexpected")))
