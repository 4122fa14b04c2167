"""Queries over state: catalog, files, compaction, recovery, buffers, runs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .functions import rules
from .model import DATASETS
from .operators import audit, cdc, latest, progress, recovery, relations, streaks
from .plans import query, sites
from .queries import FORUM, SEOUL, catalog_files, cdc_state, events, shown, spec, versions
from .queries_sql import CAT, COLS, REC, VER
from .queries_sql import SEOUL as SEOUL_SQL
from .registry import Registry, scratch, table
from .sources import catalog, files, lake
from .sources import versions as tables
from .streaming import buffer, ingest, runtime

R = Registry()
QUERIES, SQL, twin = R.queries, R.sql, R.twin


def now():
    return F.lit("2026-08-01 00:00:00").cast("timestamp")


DESCRIBED = "file_path, row_count, storage_status, lifecycle_status"


# Catalog


@twin(f"WITH {CAT} SELECT file_path, row_count FROM files WHERE file_path = 'f/7' UNION ALL SELECT 'local', count(*) FROM files WHERE storage_status = 'local' AND lifecycle_status = 'active'")
def q_catalog_by_path(spark, sf_dir):
    own = catalog_files(spark, sf_dir)
    return catalog.by_path(own, "f/7").select("file_path", "row_count").unionByName(catalog.local_active(own).agg(F.lit("local").alias("file_path"), F.count(F.lit(1)).alias("row_count")))


@twin(f"WITH {CAT} SELECT file_path, CASE WHEN id % 6 = 0 THEN 'active' WHEN id % 2 = 0 THEN 'superseded' ELSE lifecycle_status END AS lifecycle_status FROM files")
def q_catalog_lifecycle(spark, sf_dir):
    own = catalog.with_lifecycle(catalog_files(spark, sf_dir))
    own = catalog.mark_superseded(own, own.where("id % 2 = 0").select("file_path"))
    return catalog.mark_active(own, own.where("id % 6 = 0").select("file_path")).select("file_path", "lifecycle_status")


@twin(f"WITH {CAT} SELECT row_number() OVER (ORDER BY site_id, country, dataset, partition_date, bucket, file_path) AS id, file_path, row_count * CASE WHEN id % 3 = 0 THEN 2 ELSE 1 END AS row_count, 'local' AS storage_status, 'active' AS lifecycle_status, CAST(2 AS INTEGER) AS version FROM files")
def q_catalog_saved(spark, sf_dir):
    """Registered in two steps, each saved; a second registration changes a description and keeps ids and states."""
    root, own = scratch(spark), catalog_files(spark, sf_dir)
    catalog.register(spark, root, own)
    after = catalog.register(spark, root, own.where("id % 3 = 0").withColumn("row_count", F.col("row_count") * 2))
    return after.select("id", *DESCRIBED.split(", "), F.lit(tables.current(spark, root)).alias("version"))


# Lake


#: Forum posts with a bucket a day, so that a lake of all events has few files.
DAILY = replace(FORUM, buckets=1)


def small_lake(spark, sf_dir, n=1):
    """All events as a lake under a folder with blanks, written n times with later crawl times."""
    root, rows = f"{scratch(spark)}/a b é", events(spark, sf_dir)
    for i in range(n):
        lake.write_lake(rows.withColumns({"crawled_at": F.col("crawled_at") + F.make_dt_interval(F.lit(i)), "title": F.concat("title", F.lit(str(i)))}), DAILY, root)
    return root


def registered(spark, root):
    read = spark.read.option("recursiveFileLookup", True).parquet(root)
    made = lake.files_of(read, DAILY)
    own = catalog.upserted(catalog.empty(spark), lake.with_checksums(spark, made, lake.paths_of(read)))
    return catalog.mark_uploaded(own, own.select("file_path", F.col("file_path").alias("remote_path")))


@twin(f"WITH {REC}, r AS (SELECT * FROM rec) SELECT strftime(event_time, '%Y-%m-%d') AS day, CAST(sum(1) AS BIGINT) AS n_rows, strftime(min(event_time), '%Y-%m-%dT%H:%M:%S.%f') AS first_event, CAST(64 AS INTEGER) AS sha_length, CAST(1 AS INTEGER) AS schema_version FROM r GROUP BY 1")
def q_files_of(spark, sf_dir):
    """What a written lake's files hold, by day: their rows, times and checksums as the catalog gets them."""
    own = registered(spark, small_lake(spark, sf_dir))
    return shown(own.groupBy(F.date_format("partition_date", "yyyy-MM-dd").alias("day")).agg(F.sum("row_count").alias("n_rows"), F.min("min_event_time").alias("first_event"), F.max(F.length("sha256")).alias("sha_length"), F.max("schema_version").alias("schema_version")))


@twin(f"WITH {REC} SELECT record_uid, instrument_id FROM rec WHERE {SEOUL_SQL}")
def q_checked_files(spark, sf_dir):
    """A query on files whose sizes are held against the catalog."""
    return shown(query.on_catalog(spark, registered(spark, small_lake(spark, sf_dir)), spec(columns=("record_uid", "instrument_id"), **SEOUL), check_size=True))


@twin(f"WITH {REC} SELECT record_uid, title || '2' AS title, CAST(3 AS BIGINT) AS was FROM rec")
def q_compact_dataset(spark, sf_dir):
    """Three copies of a lake under a folder with blanks, compacted: the last version of each record, and how often it was there."""
    root, out = small_lake(spark, sf_dir, 3), f"{scratch(spark)}/compact ed"
    before = registered(spark, root)
    published = []

    def publish(where):
        published.append(where)
        read = spark.read.option("recursiveFileLookup", True).parquet(where)
        return lake.with_checksums(spark, lake.files_of(read, DAILY), lake.paths_of(read))

    after = latest.compact_dataset(spark, before, out, publish)[1]
    if len(published) != 1:
        raise AssertionError("published more than once")
    old = query.on_catalog(spark, before, spec(columns=("record_uid",))).groupBy("record_uid").agg(F.count(F.lit(1)).alias("was"))
    return query.on_catalog(spark, after, spec(columns=("record_uid", "title"))).join(old, "record_uid")


@twin(f"WITH {REC}, r AS (SELECT {COLS} FROM rec) SELECT CAST(7 AS BIGINT) AS n, true AS early, CAST(1 AS BIGINT) AS lookups, true AS fewer, true AS bounded FROM r LIMIT 1")
def q_streamed_rows(spark, sf_dir):
    """The first rows in catalog order: how many come, from how few files, with how many catalog lookups."""
    stats, own = query.QueryStats(), registered(spark, small_lake(spark, sf_dir))
    asked = spec(instrument_ids=[f"XUSR:{i:06d}" for i in range(2000)])
    rows = query.streamed(spark, own, asked, 7, stats)
    query.lookups_hold(stats, 2000)
    return rows.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(stats.stopped_early).alias("early"), F.lit(stats.catalog_lookups).cast("long").alias("lookups"), F.lit(stats.parquet_files_read < stats.catalog_files).alias("fewer"), F.lit(query.memory_holds(stats, 65_536, 1 << 20)).alias("bounded"))


@twin(f"WITH {REC} SELECT record_uid, instrument_id FROM rec WHERE instrument_id IN ('XUSR:000008', 'XUSR:000046', 'XUSR:000011')")
def q_legacy_buckets(spark, sf_dir):
    """Yearly files whose buckets are partly from before there was one bucket only."""
    old = dict(DATASETS)["financial_report_instrument"]
    rows = events(spark, sf_dir, old).withColumn("dataset", F.lit(old.name))
    uid = events(spark, sf_dir).select("source_id", F.col("record_uid").alias("_u"))
    root = scratch(spark)
    lake.write_lake(rows.where("cast(source_id as long) % 2 = 0"), old, root)
    lake.write_lake(rows.where("cast(source_id as long) % 2 > 0"), replace(old, buckets=256), root)
    got = query.on_lake(lake.read_lake(spark, root), spec(dataset=old.name, columns=("source_id", "instrument_id"), instrument_ids=["XUSR:000008", "XUSR:000046", "XUSR:000011"]))
    return got.join(uid, "source_id").select(F.col("_u").alias("record_uid"), "instrument_id")


@twin("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'source_id is required' ELSE 'crawled_at is required' END AS problems FROM supplier WHERE s_suppkey % 3 < 2")
def q_rejected_rows(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.lit("s").alias("site_id"), F.lit("kr").alias("country"), k.cast("string").alias("title"), F.when(k % 3 > 0, k.cast("string")).otherwise("　 ").alias("source_id"), F.when(k % 3 != 1, now()).alias("crawled_at"))
    return lake.rejected(rows, FORUM).select(F.col("title").cast("long").alias("s_suppkey"), F.array_join("problems", "; ").alias("problems"))


@twin("SELECT s_suppkey, s_name AS instrument_id FROM supplier")
def q_json_sidecars(spark, sf_dir):
    """One JSON file a row, read as manifests; ids that a file of JSON lines has."""
    root, rows = scratch(spark), table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("instrument_id"))
    rows.repartition(16).write.json(f"{root}/m")
    known = lake.existing_ids(spark, f"{root}/m", "instrument_id")
    return lake.read_manifests(spark, f"{root}/m", rows.schema).unionByName(rows).distinct().join(known, "instrument_id")


@twin("WITH c AS (SELECT c_custkey AS scope FROM customer) SELECT scope, CASE WHEN scope % 4 = 0 THEN '{\"v\":2}' WHEN scope % 2 = 0 THEN '{\"v\":1}' ELSE '{}' END AS state FROM c")
def q_checkpoints(spark, sf_dir):
    """Checkpoints saved twice, then loaded for all scopes."""
    scopes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scope"))
    root = scratch(spark)
    for v, every in ((1, 2), (2, 4)):
        lake.store_checkpoints(spark, root, scopes.where(f"scope % {every} = 0").withColumn("state", F.lit(f'{{"v":{v}}}')), ["scope"])
    return lake.load_checkpoint(scopes, tables.load(spark, root, "scope long, state string"), ["scope"])


@twin("WITH u AS (SELECT c_custkey + 1 AS pos, 'XNAT:' || c_custkey AS instrument_id FROM customer) SELECT instrument_id, 'all' AS part FROM u UNION ALL SELECT instrument_id, 'first' FROM u WHERE pos <= 5 UNION ALL SELECT instrument_id, 'asked' FROM u")
def q_universe_file(spark, sf_dir):
    """A universe written, read with its header checked, cut to a prefix, and read as a plain list."""
    root = scratch(spark)
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("pos"), F.concat(F.lit("XNAT:"), "c_custkey").alias("instrument_id"))
    lake.write_universe(own, root)
    back = lake.read_universe(spark, root)
    tag = lambda df, name: df.select("instrument_id", F.lit(name).alias("part"))
    asked = query.asked_instruments(None, [], [r["instrument_id"] for r in lake.read_instruments(spark, root).collect()])
    return tag(back, "all").unionByName(tag(lake.prefix(back, 5), "first")).unionByName(tag(spark.createDataFrame([(i,) for i in asked], "instrument_id string"), "asked"))


@twin("SELECT min(s_suppkey) AS pos, 'XKRX:' || lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS instrument_id FROM supplier GROUP BY s_nationkey")
def q_csv_universe(spark, sf_dir):
    from .functions.sites import naver_instrument

    root, s = scratch(spark), table(spark, sf_dir, "supplier")
    s.orderBy("s_suppkey").select(F.lpad(F.col("s_nationkey").cast("string"), 6, "0").alias("code"), "s_name").coalesce(1).write.option("header", True).csv(root)
    return lake.csv_universe(spark, root, "code", naver_instrument)


@twin("SELECT r_regionkey, CASE WHEN r_regionkey = 0 THEN 'rejected' WHEN r_regionkey IN (3, 4) THEN CASE WHEN r_regionkey = 3 THEN 'stored' ELSE 'same' END ELSE 'stored' END AS status, CASE WHEN r_regionkey = 0 THEN 'not a PDF' END AS problem FROM region")
def q_attachments(spark, sf_dir):
    """Files by their content: kept once each, unless they are no PDF."""
    root = scratch(spark)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in table(spark, sf_dir, "region").collect():
        out = hadoop.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/in/{r['r_regionkey']}.pdf"), True)
        out.write(bytearray(f"%PDF-{min(r['r_regionkey'], 3)}".encode() if r["r_regionkey"] else b"<html>"))
        out.close()
    got = lake.store_attachments(spark, [f"{root}/in"], f"{root}/kept")
    return got.select(F.regexp_extract("path", r"(\d+)\.pdf$", 1).cast("int").alias("r_regionkey"), "status", "problem")


@twin("SELECT 'verified' AS status, true AS gone, 'safe to delete' AS reason FROM events LIMIT 1")
def q_uploads(spark, sf_dir):
    """Files copied to another place, verified there and deleted here behind the gate."""
    own, there = registered(spark, small_lake(spark, sf_dir)), scratch(spark)
    told = files.uploaded(spark, own, there).collect()
    told = spark.createDataFrame(told, "file_path string, remote_path string, status string")
    up, ok = rules.upload_flags(F.col("status"))
    gated = told.select("file_path", up.alias("uploaded"), ok.alias("verified"), *[F.lit(True).alias(c) for c in ("catalog_registered", "seen_committed", "checkpoint_committed")])
    done = spark.createDataFrame(files.cleaned(spark, gated, dry_run=False).collect(), "file_path string, deleted boolean, reason string")
    left = [r["file_path"] for r in done.collect() if files.size_of(spark, r["file_path"]) is not None]
    return told.join(done, "file_path").select("status", (F.col("deleted") & F.lit(not left)).alias("gone"), "reason").distinct()


# Changes


@twin(f"WITH {VER} SELECT 'present' AS side, g.record_uid FROM g SEMI JOIN f USING (record_uid) UNION ALL SELECT 'write', record_uid FROM (SELECT record_uid, version_hash FROM g EXCEPT SELECT record_uid, version_hash FROM f)")
def q_cdc_sides(spark, sf_dir):
    first, again = versions(spark, sf_dir)
    tag = lambda df, side: df.select(F.lit(side).alias("side"), "record_uid")
    return tag(cdc.present(again, cdc_state(first)), "present").unionByName(tag(cdc.to_write(again.select("record_uid", "version_hash"), cdc_state(first)), "write"))


@twin(f"WITH {VER}, m AS (SELECT f.record_uid, g.version_hash AS w, f.version_hash AS v FROM f JOIN g USING (record_uid)) SELECT (SELECT count(*) FROM g) AS n_rows, CAST(0 AS BIGINT) AS n_missing, count(*) FILTER (w <> v) AS n_mismatch, CAST(0 AS BIGINT) AS n_lost, (SELECT count(*) FROM f) - (SELECT count(*) FROM g) AS n_extra_before, count(*) FILTER (w <> v) = 0 AS ok FROM m")
def q_rebuilt_check(spark, sf_dir):
    first, again = versions(spark, sf_dir)
    told = latest.published_check(again, again, cdc_state(first))
    lost = latest.published_check(first, again, cdc_state(first)).select(F.col("n_lost").alias("n_extra_before"))
    return told.drop("n_extra").crossJoin(lost)


@twin(f"WITH {VER} SELECT f.record_uid, coalesce(g.version_hash, f.version_hash) AS version_hash FROM f LEFT JOIN g USING (record_uid)")
def q_rehashed(spark, sf_dir):
    first, again = versions(spark, sf_dir)
    return latest.rehashed(cdc_state(first), again)


@twin(f"WITH {CAT} SELECT file_path, CASE WHEN id % 4 = 0 THEN 'archived' ELSE lifecycle_status END AS lifecycle_status FROM files")
def q_retired(spark, sf_dir):
    own = catalog_files(spark, sf_dir)
    return latest.retired(own, own.where("id % 4 = 0").select("file_path"), own.where("id % 4 = 1").select("file_path")).select("file_path", "lifecycle_status")


@twin(f"WITH {CAT} SELECT file_path, CASE WHEN storage_status = 'local' AND lifecycle_status = 'active' AND id % 3 > 0 THEN 'uploaded' ELSE storage_status END AS storage_status FROM files")
def q_repairs(spark, sf_dir):
    own = catalog_files(spark, sf_dir)
    there = own.select("file_path", F.concat(F.lit("r/"), "id").alias("path"), (F.col("file_size") + F.when(F.col("id") % 3 == 0, 1).otherwise(0)).alias("size"))
    return audit.repaired_uploads(own, there, dry_run=False)[1].select("file_path", "storage_status")


@twin("SELECT scope, CASE WHEN scope % 13 = 0 THEN 'BLOCKED' WHEN scope % 11 = 0 THEN 'FAILED_TERMINAL' WHEN scope % 7 = 0 THEN 'FAILED_RETRYABLE' WHEN scope % 5 = 0 THEN 'RECOVERY_PENDING' WHEN scope % 2 = 0 THEN 'DURABLE_COMPLETE' ELSE 'INCOMPLETE' END AS status FROM (SELECT c_custkey AS scope FROM customer)")
def q_resume_plan(spark, sf_dir):
    s = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("scope"))
    k = F.col("scope").cast("long")
    broken = s.select("scope", (k % 11 == 0).alias("terminal"), (k % 7 == 0).alias("retryable"), (k % 5 == 0).alias("pending")).where("terminal or retryable or pending")
    plan = audit.resume_plan(s, s.select("scope", (k % 2 == 0).alias("complete")), broken, s.where(k % 13 == 0).withColumn("reason", F.lit("waf")))
    return plan.select(F.col("scope").cast("long").alias("scope"), "status")


@twin("WITH s AS (SELECT c_custkey AS scope, CASE WHEN c_custkey % 11 = 0 THEN 'FAILED_TERMINAL' WHEN c_custkey % 2 = 0 THEN 'DURABLE_COMPLETE' ELSE 'INCOMPLETE' END AS status, 'n' || c_nationkey AS dataset FROM customer) SELECT 's' AS site_id, dataset, count(*) AS total, count(*) FILTER (status = 'DURABLE_COMPLETE') AS durable, count(*) FILTER (status = 'INCOMPLETE') AS pending, CAST(0 AS BIGINT) AS blocked, count(*) FILTER (status = 'FAILED_TERMINAL') AS failed FROM s GROUP BY dataset")
def q_resume_seeds(spark, sf_dir):
    k = F.col("c_custkey")
    return recovery.seeded(table(spark, sf_dir, "customer").select(F.lit("s").alias("site_id"), F.concat(F.lit("n"), "c_nationkey").alias("dataset"), F.when(k % 11 == 0, "FAILED_TERMINAL").when(k % 2 == 0, "DURABLE_COMPLETE").otherwise("INCOMPLETE").alias("status")))


@twin("SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'a' ELSE 'b' END AS status, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'seen', count(*) FROM orders")
def q_status_counts(spark, sf_dir):
    plan = table(spark, sf_dir, "customer").select(F.when(F.col("c_mktsegment") == "BUILDING", "a").otherwise("b").alias("status"))
    first, _ = versions(spark, sf_dir)
    root = scratch(spark)
    cdc_state(first).write.parquet(ingest.Layout(root).at("state", 0))
    seen = spark.createDataFrame([("seen", ingest.seen(spark, ingest.Layout(root)))], "status string, n long")
    return progress.status_counts(plan).unionByName(seen)


@twin("SELECT * FROM (VALUES ('forum_post', 40), ('research_report', 1), ('comment', NULL)) v(dataset, n_expected)")
def q_expected_scopes(spark, sf_dir):
    return audit.expected_scopes(spark.createDataFrame([("forum_post",), ("research_report",), ("comment",)], "dataset string"), 40)


# Recovery


def manifests(spark, sf_dir):
    """A manifest for each supplier: over all stages, some failed on their way, some for good."""
    k, stages = F.col("s_suppkey"), F.array(*[F.lit(s) for s in rules.STAGES])
    stage = F.element_at(stages, (k % 9 + 1).cast("int"))
    failed = stage == "failed"
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("m"), k).alias("manifest_id"), F.lit("s").alias("site_id"), F.lit("forum_post").alias("dataset"), F.concat(F.lit("l/"), k).alias("local_path"), F.lit(None).cast("string").alias("remote_path"), F.lit("x").alias("sha256"), k.alias("row_count"), F.array(F.concat(F.lit("s|"), k % 4)).alias("scope_tokens"),
        stage.alias("stage"), F.when(failed, F.element_at(stages, (k % 6 + 1).cast("int"))).alias("failed_from_stage"), F.when(failed, 1).otherwise(0).alias("retry_count"), F.when(failed, "timeout").alias("last_error"), F.when(failed, now()).alias("last_failed_at"), F.when(failed, k % 2 == 0).alias("retryable"), F.when(failed, "why").alias("retry_reason"), now().alias("updated_at"),
    )


MAN = "st AS (SELECT ['local', 'uploaded', 'verified', 'catalog_registered', 'seen_committed', 'checkpoint_committed', 'cleanable', 'deleted', 'failed'] AS a), m AS (SELECT s_suppkey AS k, 'm' || s_suppkey AS manifest_id, a[s_suppkey % 9 + 1] AS stage, CASE WHEN s_suppkey % 9 = 8 THEN a[s_suppkey % 6 + 1] END AS origin, a FROM supplier, st)"


@twin(f"WITH {MAN} SELECT manifest_id, CASE WHEN stage IN ('local', 'uploaded', 'verified') THEN 'catalog_registered' ELSE stage END AS stage, CASE WHEN stage IN ('local', 'uploaded', 'verified') THEN 'r/' || k END AS remote_path FROM m")
def q_manifest_moves(spark, sf_dir):
    own = manifests(spark, sf_dir)
    early = own.where(F.col("stage").isin("local", "uploaded", "verified"))
    return recovery.advanced(own, early.select("manifest_id", F.lit("catalog_registered").alias("stage"), F.concat(F.lit("r/"), "row_count").alias("remote_path")), now()).select("manifest_id", "stage", "remote_path")


@twin(f"WITH {MAN} SELECT manifest_id, CASE WHEN k % 2 = 0 THEN 'failed' ELSE stage END AS stage, CASE WHEN k % 2 = 0 AND stage <> 'failed' THEN stage ELSE origin END AS failed_from_stage, CAST(CASE WHEN stage = 'failed' THEN 1 ELSE 0 END + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS retry_count, CASE WHEN k % 2 = 0 THEN k % 4 = 0 WHEN stage = 'failed' THEN false END AS retryable, CASE WHEN k % 4 = 0 THEN 'retryable_error' WHEN k % 2 = 0 THEN 'non_retryable_error' WHEN stage = 'failed' THEN 'why' END AS retry_reason FROM m")
def q_manifest_failures(spark, sf_dir):
    own, k = manifests(spark, sf_dir), F.col("row_count")
    failures = own.where(k % 2 == 0).select("manifest_id", F.when(k % 4 == 0, "connection reset").otherwise("corrupt").alias("error"))
    return recovery.failed(own, failures, now()).select("manifest_id", "stage", "failed_from_stage", "retry_count", "retryable", "retry_reason")


@twin(f"WITH {MAN} SELECT manifest_id, true AS retryable, 'again' AS retry_reason, origin AS failed_from_stage FROM m WHERE stage = 'failed'")
def q_manifest_reclassified(spark, sf_dir):
    own = manifests(spark, sf_dir)
    after = recovery.reclassified(own, recovery.by_stage(own, "failed").select("manifest_id"), True, "again", now())
    return recovery.by_stage(after, "failed").select("manifest_id", "retryable", "retry_reason", "failed_from_stage")


@twin(f"WITH {MAN} SELECT stage, count(*) AS n, count(*) FILTER (k % 4 = 1) AS n_scope FROM m WHERE stage <> 'deleted' GROUP BY stage")
def q_manifest_stages(spark, sf_dir):
    """Manifests kept as a table in versions: those pending, by stage, and those of a scope."""
    root = scratch(spark)
    tables.save(manifests(spark, sf_dir), root)
    pending = audit.pending_manifests(tables.load(spark, root, recovery.MANIFEST))
    of_scope = audit.of_scope(pending, "s|1").groupBy("stage").agg(F.count(F.lit(1)).alias("n_scope"))
    return pending.groupBy("stage").agg(F.count(F.lit(1)).alias("n")).join(of_scope, "stage", "left").na.fill(0, ["n_scope"])


def steps():
    """Steps that do well, but for one upload in five."""
    well = lambda m: m.select("manifest_id", F.lit(None).cast("string").alias("error"))
    upload = lambda m: m.select("manifest_id", F.when(F.col("row_count") % 5 == 0, "timed out").alias("error"), F.concat(F.lit("r/"), "row_count").alias("remote_path"))
    return dict.fromkeys(recovery.STEPS, well) | {"local": upload}


REPLAY = f"{MAN}, p AS (SELECT *, coalesce(origin, stage) AS cur, stage = 'deleted' OR (stage = 'failed' AND k % 2 = 1) AS closed FROM m), r AS (SELECT *, NOT closed AND cur = 'local' AND k % 5 = 0 AS bad FROM p)"


@twin(f"WITH {REPLAY} SELECT manifest_id, stage AS original_stage, CASE WHEN closed THEN stage WHEN bad THEN 'failed' ELSE 'deleted' END AS final_stage, CASE WHEN closed THEN 'skipped' WHEN bad THEN 'failed' ELSE 'cleaned' END AS action, NOT bad AS success, CAST(CASE WHEN stage = 'failed' THEN 1 ELSE 0 END + CASE WHEN bad THEN 1 ELSE 0 END AS INTEGER) AS retry_count FROM r")
def q_recovery_replay(spark, sf_dir):
    after, results = recovery.replayed(manifests(spark, sf_dir), steps(), now())
    return results.drop("message").join(after.select("manifest_id", "retry_count"), "manifest_id")


@twin(f"WITH {REPLAY}, q AS (SELECT * FROM r WHERE stage <> 'deleted') SELECT count(*) AS scanned, count(*) FILTER (NOT closed) AS attempted, count(*) FILTER (NOT closed AND NOT bad) AS recovered, count(*) FILTER (closed) AS skipped, count(*) FILTER (bad) AS failed, count(*) FILTER (closed) AS terminal_failed, count(*) FILTER (closed OR bad) AS remaining_pending, count(*) FILTER (bad) = 0 AS can_continue FROM q")
def q_recovery_started(spark, sf_dir):
    return recovery.started(manifests(spark, sf_dir), steps(), now())[1]


@twin(f"WITH {REPLAY} SELECT count(*) AS scanned, count(*) FILTER (NOT closed AND NOT bad) AS recovered, count(*) FILTER (closed) AS skipped, count(*) FILTER (bad) AS failed, count(*) FILTER (NOT closed AND NOT bad) AS deleted FROM r")
def q_recovery_counters(spark, sf_dir):
    return recovery.counters(recovery.replayed(manifests(spark, sf_dir), steps(), now())[1])


# Buffers

LIMITS = buffer.Limits(most=20, least=5, size=400, seconds=30)
FLUSH = "ev AS (SELECT user_id, event_id, 20 + event_id % 70 AS size, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events), b AS (SELECT user_id, event_id, n, size, 0 AS flush, 1 AS rows_, size AS bytes_, 1 >= 20 OR (1 >= 5 AND size >= 400) AS reached FROM ev WHERE n = 1 UNION ALL SELECT e.user_id, e.event_id, e.n, e.size, b.flush + CASE WHEN b.reached THEN 1 ELSE 0 END, CASE WHEN b.reached THEN 1 ELSE b.rows_ + 1 END, CASE WHEN b.reached THEN e.size ELSE b.bytes_ + e.size END, CASE WHEN b.reached THEN 1 ELSE b.rows_ + 1 END >= 20 OR (CASE WHEN b.reached THEN 1 ELSE b.rows_ + 1 END >= 5 AND CASE WHEN b.reached THEN e.size ELSE b.bytes_ + e.size END >= 400) FROM b JOIN ev e ON e.user_id = b.user_id AND e.n = b.n + 1), w AS (SELECT *, coalesce(flush <= max(flush) FILTER (reached) OVER (PARTITION BY user_id), false) AS flushed FROM b)"


def buffered(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % 70 + 20).alias("size"), F.timestamp_seconds(F.col("event_id")).alias("at"), F.concat(F.lit("s"), F.col("event_id") % 3).alias("scope"))
    return buffer.flushes(rows, ["user_id"], "event_id", "size", LIMITS)


@twin(f"WITH RECURSIVE {FLUSH} SELECT user_id, event_id, CAST(flush AS BIGINT) AS flush, flushed FROM w")
def q_buffer_flush(spark, sf_dir):
    return buffered(spark, sf_dir).select("user_id", "event_id", "flush", "flushed")


@twin(f"WITH RECURSIVE {FLUSH}, l AS (SELECT user_id, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS n_bytes, min(event_id) AS first_id, bool_or(event_id % 3 = 1) AS held FROM w WHERE NOT flushed GROUP BY user_id) SELECT user_id, n_rows, n_bytes, held, first_id <= 5000 - 30 AS expired FROM l")
def q_buffer_waiting(spark, sf_dir):
    left = buffer.waiting(buffered(spark, sf_dir), ["user_id"], "size", "at", "scope")
    old = buffer.expired(left, F.timestamp_seconds(F.lit(5000)), LIMITS).select("user_id", F.lit(True).alias("expired"))
    held = buffer.holding(left, "s1").select("user_id", F.lit(True).alias("held"))
    no = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return left.join(old, "user_id", "left").join(held, "user_id", "left").select("user_id", "n_rows", "n_bytes", no("held"), no("expired"))


@twin("SELECT event_type AS scope, count(*) FILTER (event_id % 3 > 0 AND event_id % 5 = 0 AND event_id % 2 = 0) AS n_done FROM events GROUP BY 1")
def q_scope_done(spark, sf_dir):
    k = F.col("event_id")
    done = buffer.scope_done(k % 3 > 0, k % 5, k % 2)
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("scope")).agg(F.count_if(done).alias("n_done"))


@twin("SELECT event_id, user_id FROM events")
def q_buffer_stream(spark, sf_dir):
    """The buffer on a stream that ends: every row is flushed once, in flushes within the limits."""
    root = scratch(spark)
    table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("event_id") % 70 + 20).alias("size")).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("event_id long, user_id long, size long").parquet(f"{root}/in")
    flushed = buffer.buffered(stream, ["user_id"], "size", LIMITS, final=True)
    flushed.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    fair = out.groupBy("user_id", "flush").agg(F.count(F.lit(1)).alias("n")).where(f"n <= {LIMITS.most}")
    return out.join(fair, ["user_id", "flush"]).select("event_id", "user_id")


# Runs


def staged_rows(spark, sf_dir):
    """Events as raw forum rows, with their scope and place."""
    e, code = F.col("event_id"), F.lpad(F.col("user_id").cast("string"), 6, "0")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("XKRX:"), code).alias("scope"), e.alias("seq"), F.to_json(F.struct(e.alias("last"))).alias("state"), e.cast("string").alias("nid"), code.alias("code"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), F.col("event_type").alias("title"),
        *[F.lit("x").alias(c) for c in ("contents", "author_id", "author_name", "url")], now().alias("crawled_at"),
    )


@twin("SELECT 'XKRX:' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS scope, '{\"last\":' || max(event_id) || '}' AS state, count(*) AS n FROM events GROUP BY user_id")
def q_run_dataset(spark, sf_dir):
    """A run over all scopes, twice: checkpoints are the last rows', and the second run finds nothing to do."""
    root, naver, told = scratch(spark), sites.site("naver_finance"), []
    rows = staged_rows(spark, sf_dir)
    for _ in range(2):
        runtime.run_dataset(spark, naver, "forum_post", rows, root, every=100_000, hook=told.append)
    if [t.batches for t in told] != [1, 0] or not all(t.complete for t in told):
        raise AssertionError("the second run did something")
    n = ingest.records(spark, root).groupBy(F.col("scope_id").alias("scope")).agg(F.count(F.lit(1)).alias("n"))
    return runtime.checkpoints(spark, root).join(n, "scope")


@twin("WITH e AS (SELECT count(*) AS n, count(DISTINCT user_id) AS u FROM events) SELECT 'naver_finance' AS site_id, 'forum_post' AS dataset, u AS scopes, CAST(2 AS BIGINT) AS batches, n AS seen, n AS new, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged, true AS complete FROM e UNION ALL SELECT 'tossinvest', 'instrument', u, CAST(1 AS BIGINT), u, u, CAST(0 AS BIGINT), CAST(0 AS BIGINT), true FROM e")
def q_run_platform(spark, sf_dir):
    """Two sites side by side, with what each has seen."""
    root, rows = scratch(spark), staged_rows(spark, sf_dir)
    half = -(-rows.select("scope").distinct().count() // 2)
    stocks = rows.groupBy("scope").agg(F.max("seq").alias("seq"), F.max("state").alias("state"), F.first("code").alias("c")).select("scope", "seq", "state", F.concat(F.lit("A"), "c").alias("stock_key"), F.lit("n").alias("stock_name"), F.lit("").alias("href"), now().alias("crawled_at"))
    jobs = [runtime.Job(sites.site("naver_finance"), "forum_post", rows, f"{root}/a")]
    done = runtime.run_platform(spark, jobs, every=half) + runtime.run_platform(spark, [runtime.Job(sites.site("tossinvest"), "instrument", stocks, f"{root}/b")], every=100_000, budgets={"tossinvest": 1})
    return runtime.summary(spark, done)


@twin("SELECT 'XKRX:' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS scope, CAST(s_suppkey * 10 AS VARCHAR) AS nid, s_name AS title FROM supplier")
def q_staged_pages(spark, sf_dir):
    """Pages that an adapter fetched, kept as files, read by the data source and made records."""
    from .sources import staged

    rows = {f"XKRX:{r['s_suppkey']:06d}": r for r in table(spark, sf_dir, "supplier").collect()}

    class Board(staged.SiteAdapter):
        site_id = "naver_finance"

        def tasks(self, dataset):
            return list(rows)

        def fetch(self, dataset, scope):
            r = rows[scope]
            yield {"page": 1, "status": 200, "url": "u", "fetched_at": "2026-08-01T00:00:00+00:00", "body": f"<tr><td><a href='/item/board_read.naver?nid={r['s_suppkey'] * 10}'>{r['s_name']}</a></td></tr>"}
            yield {"page": 2, "status": 200, "url": "u", "fetched_at": "2026-08-01T00:00:00+00:00", "body": ""}
            raise AssertionError("a page after the empty one was fetched")

    root = scratch(spark).removeprefix("file://")
    staged.stage(Board(), "forum_post", root, stop=lambda pages: not pages[-1]["body"])
    naver = sites.site("naver_finance")
    raw = naver.crawl("forum_post", staged.read_staged(spark, root, "naver_finance", "forum_post"))
    return naver.normalize("forum_post", raw).select(F.col("scope_id").alias("scope"), F.col("source_id").alias("nid"), "title")


# Pages in order

USERPAGES = "SELECT user_id, CAST(day(ts) AS BIGINT) AS page, list_sort(list(DISTINCT event_id % 7)) AS ids, count(*) FILTER (event_type = 'purchase') AS n_new FROM events GROUP BY ALL"


def pages(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", F.dayofmonth("ts").cast("long").alias("page")).agg(F.sort_array(F.collect_set(F.col("event_id") % 7)).alias("ids"), F.count_if(F.col("event_type") == "purchase").alias("n_new"))


REPEAT = f"p AS ({USERPAGES}), each_ AS (SELECT user_id, page, unnest(ids) AS id FROM p), f AS (SELECT user_id, id, min(page) AS first FROM each_ GROUP BY ALL), fresh AS (SELECT e.user_id, e.page, bool_or(f.first = e.page) AS fresh FROM each_ e JOIN f USING (user_id, id) GROUP BY ALL), r AS (SELECT p.*, coalesce(ids = lag(ids) OVER (PARTITION BY user_id ORDER BY page), false) OR NOT fresh AS repeats FROM p JOIN fresh USING (user_id, page))"


@twin(f"WITH {REPEAT} SELECT user_id, page, repeats FROM r")
def q_repeated_pages(spark, sf_dir):
    return streaks.repeated_page(pages(spark, sf_dir), ["user_id"], "page", "ids").select("user_id", "page", "repeats")


@twin(f"WITH {REPEAT}, q AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY page) AS part FROM r), s AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, part ORDER BY page) AS known FROM q), w AS (SELECT user_id, page, CASE WHEN repeats THEN 'repeated' WHEN known >= 2 THEN 'known' END AS why FROM s) SELECT user_id, min(page) FILTER (why IS NOT NULL) AS stop_page, arg_min(why, page) FILTER (why IS NOT NULL) AS why FROM w GROUP BY user_id")
def q_paging_stop(spark, sf_dir):
    return streaks.paging_stop(pages(spark, sf_dir), ["user_id"], "page", "ids", "n_new", empty=1, known=2)


@twin(f"WITH p AS ({USERPAGES}), e AS (SELECT user_id, min(page) FILTER (n_new = 0) AS empty FROM p GROUP BY user_id) SELECT user_id, page FROM p JOIN e USING (user_id) WHERE empty IS NULL OR page < empty")
def q_until_empty(spark, sf_dir):
    return streaks.until_empty(pages(spark, sf_dir), ["user_id"], "page", "n_new").select("user_id", "page")


@twin(f"WITH p AS ({USERPAGES}), q AS (SELECT * FROM p WHERE page >= 3), e AS (SELECT user_id, min(page) FILTER (n_new = 0) AS empty FROM q GROUP BY user_id), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY page) AS at_ FROM q), w AS (SELECT user_id, page FROM r JOIN e USING (user_id) WHERE at_ <= 4 AND (empty IS NULL OR page < empty)) SELECT w.user_id, w.page, event_id FROM w JOIN events ON events.user_id = w.user_id AND day(ts) = w.page")
def q_relation_pages(spark, sf_dir):
    """All rows of at most four pages from the third on, up to the first without news; rows that come again stay."""
    read = streaks.until_empty(pages(spark, sf_dir), ["user_id"], "page", "n_new", start=3, most=4).select("user_id", "page")
    rows = table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").cast("long").alias("page"), "event_id")
    return read.join(rows, ["user_id", "page"])


@twin("WITH b AS (SELECT user_id, CAST(day(ts) AS BIGINT) AS page, event_id % 40 AS id FROM events), n AS (SELECT user_id, id, min(page) AS page FROM b WHERE id % 4 > 0 GROUP BY ALL), c AS (SELECT DISTINCT user_id, page FROM b), k AS (SELECT c.user_id, c.page, count(n.id) AS n_new FROM c LEFT JOIN n USING (user_id, page) GROUP BY ALL), q AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY page) AS part FROM k), s AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, part ORDER BY page) AS streak FROM q), t AS (SELECT user_id, min(page) FILTER (streak >= 2) AS stop_page FROM s GROUP BY user_id) SELECT user_id, page, id FROM n JOIN t USING (user_id) WHERE stop_page IS NULL OR page <= stop_page")
def q_harvest(spark, sf_dir):
    batches = table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").cast("long").alias("page"), (F.col("event_id") % 40).alias("id"))
    known = batches.where("id % 4 = 0").select("id").distinct()
    return streaks.harvested(batches, known, ["user_id"], "page", "id", after=2)


@twin("SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def q_signature(spark, sf_dir):
    return streaks.signature(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role").select("conv_id", F.array_join("signature", ",").alias("roles"))


@twin("SELECT CAST(3 AS INTEGER) AS pos, 'r3' AS stage, true AS valid FROM region LIMIT 1")
def q_next_stage(spark, sf_dir):
    """The first rollout stage that isn't done, and whether its instruments are as many as they should be."""
    stages = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("pos"), F.concat(F.lit("r"), "r_regionkey").alias("stage"))
    own = table(spark, sf_dir, "nation").select(F.concat(F.lit("X:"), "n_nationkey").alias("instrument_id"))
    return streaks.next_stage(stages, stages.where("pos < 3").select("stage")).crossJoin(streaks.stage_size(own.unionByName(own), 20, 30).select("valid"))


# Records and what belongs to them


@twin("SELECT o_orderkey, 'i' || u AS instrument_id FROM (SELECT o_orderkey, unnest(range(o_orderkey % 4)) AS u FROM orders)")
def q_fanned_out(spark, sf_dir):
    ids = F.concat(F.transform(F.slice(F.sequence(F.lit(0), F.lit(4)), F.lit(1), (F.col("o_orderkey") % 4).cast("int")), lambda i: F.concat(F.lit("i"), i)), F.array(F.lit(" ")))
    return relations.fanned_out(table(spark, sf_dir, "orders").select("o_orderkey", ids.alias("instrument_ids")))


@twin("SELECT o_custkey, arg_min(o_orderpriority, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END * CAST(1000000000 AS BIGINT) + o_orderkey) AS priority FROM orders GROUP BY 1")
def q_first_of_types(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    first = o.groupBy("o_custkey", "o_orderstatus").agg(F.min_by("o_orderpriority", "o_orderkey").alias("priority"))
    return relations.first_of_types(first, "o_custkey", ["O", "F", "P"], "o_orderstatus").select("o_custkey", "priority")


@twin("SELECT o_orderkey, o_orderstatus = 'F' AS good FROM orders")
def q_parted(spark, sf_dir):
    good, bad = relations.parted(table(spark, sf_dir, "orders").withColumn("ok", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus") == "F")), "ok")
    return good.select("o_orderkey", F.lit(True).alias("good")).unionByName(bad.select("o_orderkey", F.lit(False).alias("good")))


@twin(f"WITH {REC} SELECT record_uid, 'a' || e AS attachment_id FROM rec WHERE e % 10 = 0")
def q_attached(spark, sf_dir):
    rows = events(spark, sf_dir).select("record_uid", "source_id")
    own = rows.where("cast(source_id as long) % 10 = 0").select(F.col("record_uid").alias("parent_record_uid"), F.concat(F.lit("a"), "source_id").alias("attachment_id"))
    return relations.attached(rows, own).select("record_uid", "attachment_id")


@twin("WITH s AS (SELECT user_id % 3 AS queue, event_id AS at_, user_id AS size FROM events) SELECT queue, arg_max(size, at_) AS current, max(size) AS most FROM s GROUP BY queue")
def q_queue_gauges(spark, sf_dir):
    return progress.queue_gauges(table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("queue"), F.col("event_id").alias("at"), F.col("user_id").alias("size")))


@twin("SELECT event_type AS dataset, count(*) FILTER (event_id % 3 = 0) AS n_files, CAST(coalesce(sum(user_id) FILTER (event_id % 3 = 0), 0) AS BIGINT) AS n_bytes, count(*) FILTER (event_id % 3 > 0) AS n_records FROM events GROUP BY 1")
def q_activity(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), F.when(F.col("event_id") % 3 == 0, "file").otherwise("record").alias("kind"), F.col("user_id").alias("n_bytes"))
    return progress.activity(rows)


@twin("SELECT 'run' AS run_id, CAST(sum(total) AS BIGINT) AS total, CAST(sum(records) AS BIGINT) AS records, count(*) AS datasets FROM (SELECT user_id % 3 AS site, event_type, count(*) AS total, sum(user_id) AS records FROM events GROUP BY ALL)")
def q_run_manifest(spark, sf_dir):
    """A run's counters as JSON, written and read again, and its rows as text."""
    from .queries import run_states

    root = scratch(spark)
    progress.write_manifest(run_states(spark, sf_dir), "run", root)
    back = spark.read.json(root).select("run_id", "total", "records", "datasets")
    if query.printed(back, 1, as_json=True).count("\n") or not query.printed(back).startswith("1. run_id=run"):
        raise AssertionError("a row isn't printed as one line")
    return back


@twin("SELECT CAST(3600 AS DOUBLE) * 5 AS later")
def q_eta(spark, sf_dir):
    return progress.eta_seconds(spark.createDataFrame([(2, 12, 7200.0)], "completed long, total long, elapsed double").withColumn("elapsed", F.col("elapsed") / 2 * 2)).select((F.col("eta_seconds") / 2).alias("later"))
