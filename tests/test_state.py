"""Saved catalogs, safe compaction, recovery, buffers, runs, staged pages, and the twins of their queries."""

import datetime as dt

import __spark_entry__ as entry
import duckdb
import pyarrow as pa
import pytest
from lakeloom import queries_sites, queries_state, queries_values
from lakeloom.functions import dates, dom, pages, sites, text
from lakeloom.model import DATASETS
from lakeloom.operators import latest, recovery
from lakeloom.plans import query
from lakeloom.plans import sites as plugins
from lakeloom.sources import catalog, files, lake, staged, versions
from lakeloom.streaming import buffer, ingest, runtime
from pyspark.sql import functions as F

FORUM = DATASETS["forum_post"]


def now():
    return F.lit("2026-08-01 00:00:00").cast("timestamp")


FOLDER = "/root/testdata/sf0.001"
#: Queries that write thousands of files, or run a stream; the driver's check has them too.
SLOW = {"q_compact_dataset", "q_files_of", "q_checked_files", "q_uploads", "q_streamed_rows", "q_legacy_buckets", "q_recovery_started", "q_recovery_counters"}
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations embeddings".split()


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in TABLES:
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return out


@pytest.mark.parametrize("name", [n for m in (queries_values, queries_state, queries_sites) for n in m.QUERIES if n not in SLOW])
def test_twins_agree(spark, con, name):
    made = con.execute(entry.oracle_sql()[name])
    columns, want = [d[0] for d in made.description], made.fetchall()
    got = entry.queries()[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, want))


def records(spark, n=6, crawl="2026-08-01"):
    rows = [("s", "kr", str(i), "instrument", f"XKRX:{i % 2:06d}", f"XKRX:{i % 2:06d}", dt.datetime(2026, 7, 1 + i % 3), dt.datetime.fromisoformat(crawl), f"t{crawl}") for i in range(n)]
    return lake.canonical(spark.createDataFrame(rows, "site_id string, country string, source_id string, scope_type string, scope_id string, instrument_id string, event_time timestamp, crawled_at timestamp, title string"), FORUM)


def registered(spark, root):
    read = spark.read.option("recursiveFileLookup", True).parquet(root)
    own = catalog.upserted(catalog.empty(spark), lake.with_checksums(spark, lake.files_of(read, FORUM), lake.paths_of(read)))
    return catalog.mark_uploaded(own, own.select("file_path", F.col("file_path").alias("remote_path")))


@pytest.mark.parametrize("folder", ["a b", "é한 +&", "plain"])
def test_compaction_of_any_path(spark, tmp_path, folder):
    root = str(tmp_path / folder)
    for crawl in ("2026-08-01", "2026-08-02"):
        lake.write_lake(records(spark, crawl=crawl), FORUM, root)
    own, calls = registered(spark, root), []
    after = latest.compact_dataset(spark, own, str(tmp_path / f"out {folder}"), lambda p: (calls.append(p), lake.files_of(spark.read.option("recursiveFileLookup", True).parquet(p), FORUM).withColumn("sha256", F.lit("x")))[1])[1]
    got = query.on_catalog(spark, after, query.QuerySpec("s", "forum_post"), check_size=True).collect()
    assert len(calls) == 1 and len(got) == 6 and {r.title for r in got} == {"t2026-08-02"}


def test_compaction_stops_before_it_loses_rows(spark, tmp_path):
    root = str(tmp_path / "lake")
    for crawl in ("2026-08-01", "2026-08-02"):
        lake.write_lake(records(spark, crawl=crawl), FORUM, root)
    own = registered(spark, root)
    wrong = own.withColumn("row_count", F.col("row_count") + 1)
    with pytest.raises(ValueError, match="the catalog says"):
        latest.compact_dataset(spark, wrong, str(tmp_path / "out"), None)
    with pytest.raises(Exception, match="size differs"):
        query.on_catalog(spark, own.withColumn("file_size", F.lit(1).cast("long")), query.QuerySpec("s", "forum_post"), check_size=True).collect()
    with pytest.raises(ValueError, match="still in use"):
        latest.retired(own, own.select("file_path"), own.select("file_path"))


def test_a_large_partition_is_several_tasks(spark, tmp_path):
    rows = records(spark, 400).withColumn("content", F.repeat("title", F.lit(50)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        lake.write_lake(rows.withColumn("event_time", F.lit("2026-07-01").cast("timestamp")), DATASETS["financial_report"], str(tmp_path / "y"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert lake.read_lake(spark, str(tmp_path / "y")).count() == 400


def test_only_directories_that_may_hold_rows_are_listed(spark, tmp_path):
    root = str(tmp_path / "a b")
    lake.write_lake(records(spark), FORUM, root)
    for how in ({}, {"start_date": "2026-07-02", "end_date": "2026-07-02"}, {"instrument_id": "XKRX:000001"}, {"start_date": "2020-01-01", "end_date": "2026-07-01"}, {"start_date": "2030-01-01", "end_date": "2030-01-02"}, {"country": "US"}):
        asked = query.QuerySpec("s", "forum_post", columns=("record_uid", "event_time"), **how)
        got, want = (q.collect() for q in (query.on_root(spark, root, asked), query.on_lake(lake.read_lake(spark, root), asked)))
        assert got == want, how
    one = query.normalised(query.QuerySpec("s", "forum_post", instrument_id="XKRX:000001", start_date="2026-07-02", end_date="2026-07-02"))
    assert len(query.globs(root, one)) == 1 and query.globs(root, one)[0].endswith(f"/year=2026/month=07/day=02/bucket={{{one.buckets[0]}}}")


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.load(spark, root, "a long").count() == 0 and versions.current(spark, root) == 0
    for n in range(1, 6):
        old = versions.load(spark, root, "a long")
        assert versions.save(old.unionByName(spark.range(n, n + 1).withColumnRenamed("id", "a")), root) == n
    assert versions.load(spark, root, "a long").count() == 5 and versions.load(spark, root, "a long", 4).count() == 4
    # Another writer has begun version 6.
    spark.range(1).write.parquet(versions.folder(root, 6))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        versions.save(spark.range(1), root)
    assert versions.load(spark, root, "a long").count() == 5


def test_manifest_rules(spark):
    rows = [("a", "verified", None, None), ("b", "failed", "uploaded", True), ("c", "failed", "local", False), ("d", "deleted", None, None)]
    own = spark.createDataFrame(rows, "manifest_id string, stage string, failed_from_stage string, retryable boolean")
    own = own.select(*[(F.col(f.name) if f.name in own.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in recovery.MANIFEST])
    move = lambda i, s: spark.createDataFrame([(i, s)], "manifest_id string, stage string")
    for bad, why in ((("a", "local"), "backward"), (("b", "deleted"), "replay only"), (("a", "nowhere"), "unknown stage"), (("x", "deleted"), "no such manifest")):
        with pytest.raises(Exception, match=why):
            recovery.advanced(own, move(*bad), now()).collect()
    with pytest.raises(Exception, match="not failed"):
        recovery.reclassified(own, ["a"], True, "x", now()).collect()
    assert recovery.reclassified(own, ["c"], True, "x", now()).where("retryable").count() == 2
    well = lambda m: m.select("manifest_id", F.lit(None).cast("string").alias("error"))
    after, row = recovery.started(own, dict.fromkeys(recovery.STEPS, well), now(), block_on_terminal=True)
    assert dict(after.select("manifest_id", "stage").collect()) == {"a": "deleted", "b": "deleted", "c": "failed", "d": "deleted"}
    assert row.first().asDict() == {"scanned": 3, "attempted": 2, "recovered": 2, "skipped": 1, "failed": 0, "terminal_failed": 1, "remaining_pending": 1, "can_continue": False}
    # A stage without a step is as far as it goes; nothing is lost on the way.
    half, results = recovery.replayed(own, {"verified": well}, now())
    assert dict(half.select("manifest_id", "stage").collect()) == {"a": "catalog_registered", "b": "failed", "c": "failed", "d": "deleted"}
    assert recovery.counters(results).first().asDict() == {"scanned": 4, "recovered": 1, "skipped": 3, "failed": 0, "deleted": 0}


def test_buffer_ages(spark, tmp_path):
    """A row that waits alone is flushed by its age."""
    spark.createDataFrame([(1, 1, 5)], "k long, n long, size long").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, n long, size long").parquet(str(tmp_path / "in"))
    flushed = buffer.buffered(stream, ["k"], "size", buffer.Limits(most=10, least=10, size=100, seconds=1))
    q = flushed.writeStream.format("memory").queryName("aged").trigger(processingTime="1 second").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(40):
            if spark.table("aged").count() or not q.isActive:
                break
            q.awaitTermination(1)
        assert [(r.k, r.n, r.flush, r.reason) for r in spark.table("aged").collect()] == [(1, 1, 0, "age")]
    finally:
        q.stop()


def test_state_from_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "SNAPSHOT", 2)
    layout, counters = ingest.Layout(str(tmp_path)), {}
    for n in range(5):
        ingest.commit_batch(layout, counters=counters)(records(spark, n + 1, f"2026-08-0{n + 1}"), n)
    assert ingest.written(spark, layout, "snapshot") == [1, 3] and ingest.seen(spark, layout) == 5
    assert counters[0] == {"seen": 1, "new": 1, "updated": 0, "unchanged": 0} and counters[4]["seen"] == 5 and counters[4]["new"] == 1


def test_runs(spark, tmp_path):
    raw = spark.createDataFrame([(f"XKRX:{i % 3:06d}", i, str(i), f"{i % 3:06d}") for i in range(9)], "scope string, seq int, nid string, code string")
    raw = raw.select("*", F.lit("2026-08-01T00:00:00Z").alias("date"), F.lit("title").alias("title"), *[F.lit("x").alias(c) for c in ("contents", "author_id", "author_name", "url")], now().alias("crawled_at"))
    naver, off = plugins.site("naver_finance"), runtime.Shutdown()
    off.ask()
    assert not runtime.run_dataset(spark, naver, "forum_post", raw, str(tmp_path / "a"), every=1, shutdown=off).complete
    off.ask()
    with pytest.raises(InterruptedError):
        runtime.run_dataset(spark, naver, "forum_post", raw, str(tmp_path / "a"), every=1, shutdown=off)
    done = runtime.run_platform(spark, [runtime.Job(naver, "forum_post", raw, str(tmp_path / x)) for x in "ab"], budgets={"naver_finance": 1}, every=2)
    assert [(r.scopes, r.batches, r.rows["new"]) for r in done] == [(3, 2, 9)] * 2
    again = runtime.run_dataset(spark, naver, "forum_post", raw, str(tmp_path / "a"), full=True)
    assert again.rows == {"seen": 9, "new": 0, "updated": 0, "unchanged": 9}
    with pytest.raises(ValueError, match="not a record of"):
        naver.validate("comment", records(spark))


def test_staged_pages_are_kept_once(tmp_path, spark):
    class Site(staged.SiteAdapter):
        site_id = "x"
        fetched = 0

        def tasks(self, dataset):
            return ["a/1", "b"]

        def fetch(self, dataset, scope):
            for p in range(5):
                Site.fetched += 1
                yield {"page": p, "body": "" if p == 2 else "y"}

    stop = lambda got: not got[-1]["body"]
    assert staged.stage(Site(), "d", str(tmp_path), stop) == 6 and staged.stage(Site(), "d", str(tmp_path), stop) == 0 and Site.fetched == 6
    assert staged.read_staged(spark, str(tmp_path)).groupBy("scope").count().count() == 2 and not list(Site().attachments({}))


def test_small_staged_files_share_partitions(tmp_path, spark):
    class Site(staged.SiteAdapter):
        site_id = "x"

        def tasks(self, dataset):
            return [f"s{i:03d}" for i in range(300)]

        def fetch(self, dataset, scope):
            yield {"page": 1, "body": scope}
            yield {"page": 2, "body": ""}

    staged.stage(Site(), "d", str(tmp_path))
    read = staged.read_staged(spark, str(tmp_path))
    assert 4 <= read.rdd.getNumPartitions() <= 8
    assert sorted((r.scope, r.page, r.body) for r in read.collect()) == sorted(x for i in range(300) for x in ((f"s{i:03d}", 1, f"s{i:03d}"), (f"s{i:03d}", 2, "")))
    big, small = staged.PARTITION, {f"f{i}": 1 for i in range(1000)}
    parts = staged.packed({"a": big, **small, "z": big}, 1)
    assert [len(p) for p in parts] == [1, 511, 489, 1] and sum(parts, []) == ["a", *small, "z"]
    assert staged.packed({}, 4) == []


def test_files(spark, tmp_path):
    (tmp_path / "a b.txt").write_text("x")
    assert files.copied(spark, [(f"{tmp_path}/a b.txt", f"{tmp_path}/o/c d.txt", 1)]) == ["stored"]
    assert files.copied(spark, [(f"{tmp_path}/a b.txt", f"{tmp_path}/o/c d.txt", 1)]) == ["present"]
    with pytest.raises(OSError, match="another size"):
        files.copied(spark, [(f"{tmp_path}/a b.txt", f"{tmp_path}/o/e.txt", 7)])
    gated = spark.createDataFrame([(f"{tmp_path}/a b.txt", True, True, True, True, False)], "file_path string, uploaded boolean, verified boolean, catalog_registered boolean, seen_committed boolean, checkpoint_committed boolean")
    assert files.cleaned(spark, gated, dry_run=False).first().reason == "checkpoint not committed" and (tmp_path / "a b.txt").exists()


def test_small_rules(spark):
    batch = pa.record_batch({"instrument_id": ["a", None, None, "b"], "relations_json": [None, '[{"instrument_id":"a"}]', "bad", "[]"]})
    assert query.first_of_batch(batch, ["a"]).num_rows == 2
    with pytest.raises(AssertionError):
        query.lookups_hold(query.QueryStats(catalog_lookups=5), 5)
    with pytest.raises(ValueError):
        query.asked_instruments(None, [], [" "])
    with pytest.raises(ValueError):
        sites.research_categories(["nothing"])
    with pytest.raises(Exception, match="not a time"):
        spark.createDataFrame([("soon",)], "t string").select(dates.iso_time(F.col("t"))).collect()
    assert spark.createDataFrame([("\u3000\x1c a\u2003",)], "t string").select(text.strip(F.col("t"))).first()[0] == "a"
    assert [n.text() for n in dom.parse("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>").all("li", "td")] == list("abcde")
    assert pages.hkex_results(None) == [] and pages.news_metadata("{bad", "x")["title"] == "" and pages.kabutan_article("", "t")["title"] == "t"
