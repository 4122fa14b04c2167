"""Decision rules as Columns: retry, recovery, resume, retention, cleanup, rollout, progress."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fragments of error messages.
FATAL = [
    "sha256 mismatch", "checksum mismatch", "row count mismatch", "record index row count mismatch", "invalid record index",
    "record index sidecar missing", "invalid parquet", "schema mismatch", "schema version", "corrupt", "malformed",
    "cannot reconstruct partition", "invalid partition date", "invalid recovery bucket",
]
TRANSIENT = [
    "timeout", "timed out", "connection reset", "connection refused", "connection aborted", "connection closed",
    "network is unreachable", "broken pipe", "could not connect", "server closed the connection", "temporary failure",
    "temporarily unavailable", "temporary seen store failure", "temporary database failure", "temporary network failure",
    "temporary upload failure", "rsync failed", "ssh failed", "remote unavailable", "setlocale: lc_all: cannot change locale",
    "cannot change locale", "database is locked", "deadlock", "serialization failure", "too many connections",
]
STAGE_ACTIONS = {
    "local": "upload_and_verify", "uploaded": "verify_remote", "verified": "register_catalog", "catalog_registered": "commit_seen",
    "seen_committed": "advance_checkpoint_marker", "checkpoint_committed": "clean_local", "cleanable": "clean_local", "deleted": "none",
}
STAGES = [*list(STAGE_ACTIONS), "failed"]


def has_any(text: Column, words: list[str]) -> Column:
    return reduce(Column.__or__, [text.contains(w) for w in words])


def retry_decision(error: Column, retries: Column, most: int = 3) -> Column:
    """struct(decision, reason): fatal errors stop, then the number of retries does, then transient ones are tried again."""
    text = F.lower(F.coalesce(error, F.lit("")))
    say = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    stop = say("stop", "non_retryable_error")
    return F.when(has_any(text, FATAL), stop).when(retries >= most, say("stop", "max_retries_exceeded")).when(has_any(text, TRANSIENT), say("retry", "retryable_error")).otherwise(stop)


def recovery_action(stage: Column, retryable: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in STAGE_ACTIONS.items() for x in kv])
    return F.when(stage == "failed", F.when(retryable.eqNullSafe(False), "stop_terminal").otherwise("retry")).otherwise(F.try_element_at(known, stage))


def resume_status(blocked: Column, terminal: Column, retryable: Column, pending: Column, complete: Column) -> Column:
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(F.coalesce(blocked, F.lit("")) != "", "BLOCKED").when(yes(terminal), "FAILED_TERMINAL").when(yes(retryable), "FAILED_RETRYABLE")
        .when(yes(pending), "RECOVERY_PENDING").when(yes(complete), "DURABLE_COMPLETE").otherwise("INCOMPLETE")
    )


def should_crawl(status: Column) -> Column:
    return status.isin("INCOMPLETE", "FAILED_RETRYABLE")


# The reasons that the rules below give.
def retention(kind: Column, created_at: Column, durable: Column, failed: Column, lifecycle: Column, now: Column, keep_failures: bool = True, manifest_days: int = 30, rollback_days: int = 7, archive_first: bool = True, dry_run: bool = True) -> Column:
    """struct(decision, allowed, reason) of an artifact; whole days of age count."""
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp(created_at)) / 86400)
    say = lambda d, r, ok=False: F.struct(F.lit(d).alias("decision"), F.lit(ok).alias("allowed"), F.lit(r).alias("reason"))
    superseded = lifecycle == "superseded"
    out = F.when(~durable, say("keep", "durability barrier incomplete"))
    if keep_failures:
        out = F.when(failed, say("keep", "failed artifact retained for inspection")).when(~durable, say("keep", "durability barrier incomplete"))
    out = out.when(kind.isin("manifest", "sidecar") & (age < manifest_days), say("keep", "manifest retention window not elapsed"))
    out = out.when(superseded & (age < rollback_days), say("keep", "superseded rollback window not elapsed"))
    if archive_first:
        out = out.when(superseded, say("archive", "archive superseded artifact before deletion", not dry_run))
    return out.otherwise(say("delete", "dry-run deletion candidate" if dry_run else "retention policy permits deletion", not dry_run))


#: Steps that must be done before a local file may go, with the reason if one isn't.
GATE = {
    "uploaded": "remote upload not completed", "verified": "remote verification not completed", "catalog_registered": "postgres catalog not registered",
    "seen_committed": "seen store not committed", "checkpoint_committed": "checkpoint not committed",
}


def cleanup_gate(**done: Column) -> Column:
    """struct(can_delete, reason): the first step that isn't done says why."""
    say = lambda ok, r: F.struct(F.lit(ok).alias("can_delete"), F.lit(r).alias("reason"))
    out = say(True, "safe to delete")
    for step, reason in reversed(GATE.items()):
        out = F.when(~F.coalesce(done[step], F.lit(False)), say(False, reason)).otherwise(out)
    return out


def upload_flags(status: Column) -> tuple[Column, Column]:
    """(uploaded, verified) of an upload's status."""
    return status.isin("uploaded", "verified"), status == "verified"


def rollout_reasons(instruments: Column, attempted: Column, failed: Column, recovery_failed: Column, recovery_pending: Column, largest: Column, max_rate: float = 0.02, max_bytes: int = 512 * 1024 * 1024) -> Column:
    """Why a rollout may not grow; empty if it may."""
    rate = F.when(attempted > 0, failed / F.nullif(attempted, F.lit(0))).otherwise(1.0)
    said = [
        (instruments < 1, "instrument_count must be >= 1"), (attempted < 1, "attempted_scopes must be >= 1"),
        (rate > max_rate, "scope failure rate exceeded threshold"), (recovery_failed > 0, "recovery failures remain"),
        (recovery_pending > 0, "pending recovery remains"), (largest > max_bytes, "file size threshold exceeded"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in said]))


def dataset_status(total: Column, completed: Column, running: Column, runtime_completed: Column, blocked: Column, failed: Column) -> Column:
    return (
        F.when(failed > 0, "failed").when((blocked > 0) & (running == 0), "blocked").when((total > 0) & (completed >= total), "complete")
        .when((running > 0) | (runtime_completed > 0), "running").otherwise("pending")
    )


def group_status(status: Column, total: Column, completed: Column) -> Column:
    """Of a group's datasets; an aggregate."""
    any_ = lambda s: F.bool_or(status == s)
    return (
        F.when(any_("failed"), "failed").when(any_("blocked") & F.bool_and(status.isin("blocked", "complete")), "blocked")
        .when((total > 0) & (completed >= total), "complete").when(any_("running"), "running").otherwise("pending")
    )


def percent(completed: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(completed * 100.0 / total, 2)).otherwise(0.0)


def durable_month(state: Column) -> Column:
    """Whether a month's JSON checkpoint says that it is complete."""
    is_true = lambda p: F.coalesce(F.get_json_object(state, p) == "true", F.lit(False))
    return (is_true("$.month_complete") & is_true("$.archive_access_validated")) | (is_true("$.free_access_complete") & (F.get_json_object(state, "$.stop_reason") == "free_access_boundary"))


def durable_request(state: Column, mode: Column, signature: Column) -> Column:
    """Whether a scope's JSON checkpoint spares a full crawl: it is complete and was made by the same request."""
    same = F.get_json_object(state, "$.request_signature") == signature
    return F.coalesce((mode == "full") & (F.get_json_object(state, "$.scope_complete") == "true") & same, F.lit(False))


def month_status(state: Column) -> Column:
    """natural, free_access, failed, partial, or missing for null."""
    is_true = lambda p: F.coalesce(F.get_json_object(state, p) == "true", F.lit(False))
    reason = F.coalesce(F.get_json_object(state, "$.stop_reason"), F.lit(""))
    return (
        F.when(state.isNull(), "missing").when(is_true("$.month_complete") & is_true("$.archive_access_validated"), "natural")
        .when(is_true("$.free_access_complete") & (reason == "free_access_boundary"), "free_access")
        .when(reason.isin("http_failure", "parser_failure", "interrupted"), "failed").otherwise("partial")
    )


def run_plan_guard(instruments: Column, confirmed: Column, pending: Column, large: int = 100) -> Column:
    """struct(allowed, reason): whether a run of so many instruments may start."""
    say = lambda r: F.struct(F.lit(not r).alias("allowed"), F.lit(r).alias("reason"))
    return (
        F.when(instruments < 1, say("instruments must be 1 or more")).when((instruments > large) & ~F.coalesce(confirmed, F.lit(False)), say("a large run needs confirmation"))
        .when(pending > 0, say("recovery is still pending")).otherwise(say(""))
    )


def counter_of(state: Column, *paths: str) -> Column:
    """The first whole number that a JSON text has at one of the paths, else 0."""
    return F.coalesce(*[F.get_json_object(state, p).try_cast("bigint") for p in paths], F.lit(0).cast("bigint"))
