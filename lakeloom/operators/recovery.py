"""Manifests of files on their way to durability: the stage machine, failures, replay, and the gate at a start.

A manifest is a row; every change gives a new DataFrame, and sources.versions saves it. Replay takes all manifests of a
stage at once: as many steps as there are stages, whatever the number of manifests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..sources.versions import cut

MANIFEST = T.StructType([
    T.StructField(n, t) for t, names in (
        (T.StringType(), "manifest_id site_id dataset local_path remote_path sha256 stage failed_from_stage last_error retry_reason"), (T.LongType(), "row_count"), (T.IntegerType(), "retry_count"),
        (T.ArrayType(T.StringType()), "scope_tokens"), (T.BooleanType(), "retryable"), (T.TimestampType(), "last_failed_at updated_at"),
    ) for n in names.split()
])
#: What replay does with the manifests of a stage, the stage that follows, and how it is told.
STEPS = {"local": ("uploaded", "uploaded"), "uploaded": ("verified", "uploaded"), "verified": ("catalog_registered", "registered"), "catalog_registered": ("seen_committed", "seen_committed"), "seen_committed": ("checkpoint_committed", "seen_committed"), "checkpoint_committed": ("cleanable", "cleaned"), "cleanable": ("deleted", "cleaned")}
#: Manifests of a stage -> (manifest_id, error): null where the step went well; remote_path may come too.
Step = Callable[[DataFrame], DataFrame]


def rank(stage: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in rules.STAGES]), stage)


def _met(manifests: DataFrame, changes: DataFrame, *names: str) -> DataFrame:
    """manifests with the named columns of their change as _name, and _hit; a change of no manifest is an error."""
    own = changes.select(F.col("manifest_id").alias("_m"), *[(F.col(n) if n in changes.columns else F.lit(None).cast("string")).alias(f"_{n}") for n in names], F.lit(True).alias("_hit"))
    both = manifests.join(own, F.col("manifest_id") == F.col("_m"), "full_outer")
    known = F.when(F.col("manifest_id").isNull(), F.raise_error(F.concat(F.lit("no such manifest: "), F.col("_m"))).cast("boolean")).otherwise(F.coalesce("_hit", F.lit(False)))
    return both.withColumn("_hit", known).drop("_m")


def _changed(met: DataFrame, hit: Column, **values: Column) -> DataFrame:
    """All manifests, those that are hit with new values; the first value is evaluated for all, so its errors show."""
    return met.select(*[(F.when(hit, values[c]).otherwise(F.col(c)) if c in values else F.col(c)).cast(MANIFEST[c].dataType).alias(c) for c in MANIFEST.fieldNames()])


def advanced(manifests: DataFrame, moves: DataFrame, now: Column) -> DataFrame:
    """moves: manifest_id, stage, maybe remote_path. Stages go forward; failed is reached from anywhere and left only by
    replay. What a failure left is forgotten, except the number of tries."""
    met = _met(manifests, moves, "stage", "remote_path")
    to, at, name = F.col("_stage"), F.col("stage"), F.coalesce("manifest_id", F.lit(""))
    fail = lambda why: F.raise_error(F.concat(F.lit(f"{why}: "), name, F.lit(" "), at, F.lit(" -> "), F.coalesce(to, F.lit("")))).cast("string")
    stage = F.when(F.coalesce(rank(to), F.lit(0)) == 0, fail("unknown stage")).when(to == "failed", to).when(at == "failed", fail("a failed manifest is left by replay only")).when(rank(to) < rank(at), fail("a stage can't go backward")).otherwise(to)
    clear = lambda c: F.when(to == "failed", F.col(c))
    return _changed(met, F.col("_hit"), stage=stage, remote_path=F.coalesce("_remote_path", "remote_path"), last_error=clear("last_error"), failed_from_stage=clear("failed_from_stage"), last_failed_at=clear("last_failed_at"), retryable=clear("retryable"), retry_reason=clear("retry_reason"), updated_at=now)


def failed(manifests: DataFrame, failures: DataFrame, now: Column, most: int = 3) -> DataFrame:
    """failures: manifest_id, error. The stage it failed at stays known, tries are counted, and the error and their
    number decide whether it is tried again."""
    met = _met(manifests, failures, "error")
    told = rules.retry_decision(F.col("_error"), F.col("retry_count"), most)
    origin = F.when(F.col("stage") == "failed", F.col("failed_from_stage")).otherwise(F.col("stage"))
    return _changed(met, F.col("_hit"), stage=F.lit("failed"), failed_from_stage=origin, retry_count=F.coalesce("retry_count", F.lit(0)) + 1, last_error=F.col("_error"), last_failed_at=now, retryable=told["decision"] == "retry", retry_reason=told["reason"], updated_at=now)


def reclassified(manifests: DataFrame, ids: Iterable[str] | DataFrame, retryable: bool, reason: str, now: Column) -> DataFrame:
    """Failed manifests with another verdict; neither their stage nor their tries change. Others are an error."""
    spark = manifests.sparkSession
    ids = ids if isinstance(ids, DataFrame) else spark.createDataFrame([(i,) for i in ids], "manifest_id string")
    met = _met(manifests, ids)
    stage = F.when(F.col("stage") == "failed", F.col("stage")).otherwise(F.raise_error(F.concat(F.lit("not failed: "), F.col("manifest_id"))).cast("string"))
    return _changed(met, F.col("_hit"), stage=stage, retryable=F.lit(retryable), retry_reason=F.lit(reason), updated_at=now)


def by_stage(manifests: DataFrame, stage: str) -> DataFrame:
    return manifests.where(F.col("stage") == stage)


def terminal(manifests: DataFrame) -> Column:
    return F.coalesce((F.col("stage") == "failed") & (F.col("retryable") == F.lit(False)), F.lit(False))


def replayed(manifests: DataFrame, steps: Mapping[str, Step], now: Column, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(manifests after it, results: manifest_id, original_stage, final_stage, action, success, message).

    Deleted manifests and terminal failures are skipped; other failures go on from the stage they failed at. Each
    manifest goes as far as the steps do (a stage without a step ends the way); one whose step has an error fails.
    A step runs once, and what it gives is kept before the next one begins."""
    start = manifests.withColumns({"_from": F.col("stage"), "_action": F.lit("skipped"), "_error": F.lit(None).cast("string"), "_open": ~terminal(manifests) & (F.col("stage") != "deleted")})
    resumed = F.col("_open") & (F.col("stage") == "failed")
    at = start.withColumn("stage", F.when(resumed, F.coalesce("failed_from_stage", F.lit("local"))).otherwise(F.col("stage")))
    for stage, (following, action) in STEPS.items():
        if stage not in steps:
            continue
        here = F.col("_open") & F.col("_error").isNull() & (F.col("stage") == stage)
        done = cut(steps[stage](at.where(here).select(*manifests.columns)))
        path = F.col("remote_path") if "remote_path" in done.columns else F.lit(None).cast("string")
        told = done.select(F.col("manifest_id").alias("_m"), F.col("error").cast("string").alias("_e"), path.alias("_r"), F.lit(True).alias("_did"))
        met = at.join(told, F.col("manifest_id") == F.col("_m"), "left")
        well = F.coalesce(F.col("_did") & F.col("_e").isNull(), F.lit(False))
        at = met.withColumns({"stage": F.when(well, F.lit(following)).otherwise(F.col("stage")), "_action": F.when(well, F.lit(action)).otherwise(F.col("_action")), "_error": F.coalesce("_e", "_error"), "remote_path": F.coalesce("_r", "remote_path")}).drop("_m", "_e", "_r", "_did")
        at = cut(at)
    bad = F.col("_error").isNotNull()
    verdict = rules.retry_decision(F.col("_error"), F.col("retry_count"), most)
    moved = (F.col("stage") != F.col("_from")) & ~bad
    gone = lambda c: F.when(moved, None).otherwise(F.col(c))
    still = ~F.col("_open") | (F.col("_from") == "failed") & ~bad & (F.col("_action") == "skipped")
    after = {
        "stage": F.when(bad, "failed").when(still, F.col("_from")).otherwise(F.col("stage")), "failed_from_stage": F.when(bad, F.col("stage")).otherwise(gone("failed_from_stage")), "retry_count": F.coalesce("retry_count", F.lit(0)) + bad.cast("int"),
        "last_error": F.when(bad, F.col("_error")).otherwise(gone("last_error")), "last_failed_at": F.when(bad, now).otherwise(gone("last_failed_at")), "retryable": F.when(bad, verdict["decision"] == "retry").otherwise(gone("retryable")),
        "retry_reason": F.when(bad, verdict["reason"]).otherwise(gone("retry_reason")), "updated_at": F.when(bad | moved, now).otherwise(F.col("updated_at")),
    }
    out = at.withColumns(after)
    results = out.select("manifest_id", F.col("_from").alias("original_stage"), F.col("stage").alias("final_stage"), F.when(bad, "failed").otherwise(F.col("_action")).alias("action"), (~bad).alias("success"), F.coalesce("_error", F.when(~F.col("_open"), F.col("retry_reason"))).alias("message"))
    return out.select(*[F.col(c).cast(MANIFEST[c].dataType).alias(c) if c in MANIFEST.fieldNames() else F.col(c) for c in manifests.columns]), results


def counters(results: DataFrame) -> DataFrame:
    """One row: scanned, recovered, skipped, failed, deleted."""
    well, skipped = F.col("success"), F.col("action") == "skipped"
    return results.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(well & ~skipped).alias("recovered"), F.count_if(well & skipped).alias("skipped"), F.count_if(~well).alias("failed"), F.count_if(well & ~skipped & (F.col("final_stage") == "deleted")).alias("deleted"))


def started(manifests: DataFrame, steps: Mapping[str, Step], now: Column, block_on_failed: bool = True, block_on_terminal: bool = False, block_on_pending: bool = False) -> tuple[DataFrame, DataFrame]:
    """(manifests after replay, one row: scanned, attempted, recovered, skipped, failed, terminal_failed,
    remaining_pending, can_continue). Whether a run may start is up to what the policy blocks on."""
    pending = manifests.where(F.col("stage") != "deleted")
    after, results = replayed(pending, steps, now)
    n = counters(results).drop("deleted")
    lost = pending.agg(F.count_if(terminal(pending)).alias("terminal_failed"))
    left = after.agg(F.count_if(F.col("stage") != "deleted").alias("remaining_pending"))
    # One row each.
    row = n.crossJoin(lost).crossJoin(left).withColumn("attempted", F.col("scanned") - F.col("terminal_failed"))
    stops = [c > 0 for c, on in ((F.col("failed"), block_on_failed), (F.col("terminal_failed"), block_on_terminal), (F.col("remaining_pending"), block_on_pending)) if on]
    go = F.lit(True)
    for s in stops:
        go = go & ~s
    row = row.withColumn("can_continue", go).select("scanned", "attempted", "recovered", "skipped", "failed", "terminal_failed", "remaining_pending", "can_continue")
    return after.unionByName(manifests.where(F.col("stage") == "deleted")), row


def seeded(plan: DataFrame) -> DataFrame:
    """Per site and dataset the numbers of a resume plan (site_id, dataset, status): total, durable, pending, blocked, failed."""
    of = lambda *s: F.count_if(F.col("status").isin(*s))
    return plan.groupBy("site_id", "dataset").agg(F.count(F.lit(1)).alias("total"), of("DURABLE_COMPLETE").alias("durable"), of("INCOMPLETE", "FAILED_RETRYABLE", "RECOVERY_PENDING").alias("pending"), of("BLOCKED").alias("blocked"), of("FAILED_TERMINAL").alias("failed"))
