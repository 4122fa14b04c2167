"""The record lake: identity, layout, queries, catalog, compaction, streaming with replay."""

import datetime as dt
import json

import pytest
from lakeloom.model import COLUMNS, DATASETS, SchemaRegistry
from lakeloom.operators import audit, cdc, latest, relations, streaks
from lakeloom.plans import query, sites
from lakeloom.sources import catalog, lake
from lakeloom.streaming import ingest
from pyspark.sql import functions as F

FORUM, NEWS = DATASETS["forum_post"], DATASETS["news_article"]
T = lambda *a: dt.datetime(*a)


def raw(spark, rows):
    """rows: (source_id, instrument, event_time, title, relations)."""
    out = [("s", "kr", r[0], "instrument", r[1], r[1], r[2], T(2026, 9, 1), r[3], r[4] if len(r) > 4 else None) for r in rows]
    return spark.createDataFrame(out, "site_id string, country string, source_id string, scope_type string, scope_id string, instrument_id string, event_time timestamp, crawled_at timestamp, title string, relations array<struct<instrument_id:string,relation_type:string,confidence:double>>")


ROWS = [("a", "XKRX:005930", T(2026, 8, 25, 10), "Samsung"), ("b", "XKRX:042700", T(2026, 8, 25, 11), "Hanmi A"), ("c", "XKRX:042700", T(2026, 8, 26, 12), "Hanmi B"), ("d", "XKRX:042700", None, "no time")]


def registered(spark, root, spec=FORUM):
    made = lake.files_of(spark.read.parquet(root), spec).withColumn("sha256", F.sha2("file_path", 256))
    files = catalog.upserted(catalog.empty(spark), made)
    return catalog.mark_uploaded(files, files.select("file_path", F.col("file_path").alias("remote_path")))


def test_record_model(spark):
    rows = lake.canonical(raw(spark, [*ROWS, (" ", "x", None, "bad")]), FORUM)
    assert rows.columns == COLUMNS and rows.count() == 4
    a = rows.where("source_id = 'a'").first()
    assert a.country == "KR" and a.mutation_policy == "immutable" and len(a.record_uid) == 64
    other = lake.canonical(raw(spark, ROWS).withColumn("country", F.lit("us")).withColumn("crawled_at", F.lit("2027-01-01").cast("timestamp")), FORUM).where("source_id = 'a'").first()
    assert (other.record_uid, other.version_hash) == (a.record_uid, a.version_hash)
    with pytest.raises(Exception, match="source_id is required"):
        lake.canonical(raw(spark, [(" ", "x", None, "bad")]), FORUM, strict=True).collect()
    with pytest.raises(Exception, match="requires event_time"):
        lake.partitioned(rows, DATASETS["holding_snapshot"]).collect()
    with pytest.raises(ValueError):
        SchemaRegistry().register(FORUM)
    assert len(DATASETS) == 15


def test_yearly_partitions(spark):
    rows = lake.canonical(raw(spark, [("1", "XHKG:00005", T(2026, 3, 26), "x"), ("2", "XHKG:00700", T(2026, 9, 1), "y")]), DATASETS["financial_report"])
    got = lake.partitioned(rows, DATASETS["financial_report"]).select("partition_date", "bucket").distinct().collect()
    assert [tuple(r) for r in got] == [(dt.date(2026, 1, 1), "00")]


def test_queries_prune_and_agree(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = lake.canonical(raw(spark, ROWS), FORUM)
    lake.write_lake(rows, FORUM, root)
    files = registered(spark, root)
    spec = query.QuerySpec("s", "forum_post", instrument_ids=["XKRX:042700"], start_date="2026-08-25", end_date="2026-08-25", columns=["title", " title", "record_uid"])
    stats = query.QueryStats()
    want = [("Hanmi A",)]
    assert [(r.title,) for r in query.on_catalog(spark, files, spec, stats).collect()] == want
    assert [(r.title,) for r in query.on_lake(lake.read_lake(spark, root), spec).collect()] == want
    assert [(r.title,) for r in query.on_records(rows, spec).collect()] == want
    assert stats.catalog_files == 1 and stats.catalog_lookups == 1
    plan = query.on_lake(lake.read_lake(spark, root), spec)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(event_time" in plan
    none = query.on_catalog(spark, files, query.QuerySpec("s", "comment"))
    assert none.count() == 0 and none.columns == COLUMNS
    everything = query.on_catalog(spark, files, query.QuerySpec("s", "forum_post")).collect()
    assert [r.title for r in everything] == ["Samsung", "Hanmi A", "Hanmi B", "no time"]
    for n in (100, 1000):
        stats = query.QueryStats()
        query.on_catalog(spark, files, query.QuerySpec("s", "forum_post", instrument_ids=[f"XKRX:{i:06d}" for i in range(n)]), stats)
        assert stats.catalog_lookups == 1


def test_batches_stop_early(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.write_lake(lake.canonical(raw(spark, ROWS), FORUM), FORUM, root)
    files, stats = registered(spark, root), query.QueryStats()
    batches = list(query.iter_batches(spark, files, query.QuerySpec("s", "forum_post"), batch_size=1, max_rows=2, stats=stats))
    assert [len(b) for b in batches] == [1, 1] and stats.rows_returned == 2 and stats.parquet_files_read < stats.catalog_files
    with pytest.raises(ValueError):
        list(query.iter_batches(spark, files, query.QuerySpec("s", "forum_post"), batch_size=0))


def test_query_checks():
    day = query.normalised(query.QuerySpec("s", "forum_post", start_date="2026-08-25", end_date="2026-08-25", timezone="Asia/Seoul"))
    assert day.dates == (dt.date(2026, 8, 24), dt.date(2026, 8, 25))
    year = query.normalised(query.QuerySpec("s", "financial_report", instrument_id="XHKG:00005", start_date="2026-08-25", end_date="2026-08-26"))
    assert year.dates[0] == dt.date(2026, 1, 1) and year.buckets is None
    both = query.normalised(query.QuerySpec("s", "financial_report_instrument", instrument_id="XHKG:00016"))
    assert both.buckets == ("00", "d2") and query.normalised(query.QuerySpec("s", "news_instrument", start_date="2026-01-01", end_date="2026-01-02")).dates is None
    for bad in ({"start_date": "2026-02-01", "end_date": "2026-01-01"}, {"columns": []}, {"columns": ["x"]}, {"timezone": "No/Where"}):
        with pytest.raises(ValueError):
            query.normalised(query.QuerySpec("s", "forum_post", **bad))
    with pytest.raises(ValueError):
        query.normalised(query.QuerySpec(" ", "forum_post"))


def test_relation_filter(spark):
    cases = {'[{"instrument_id":"X:1"}]': True, '[1, "a", {"instrument_id":"X:1"}]': True, '{"instrument_id":"X:1"}': False, "bad": False, "[]": False, '[{"instrument_id":5}]': False, None: False, '[{"instrument_id":null}]': False}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "relations_json string, want boolean").withColumn("instrument_id", F.lit(None).cast("string"))
    assert all(r.got == r.want for r in rows.withColumn("got", query.related(["X:1"])).collect())
    news = lake.canonical(raw(spark, [("a", None, T(2026, 1, 1), "x", [("XKRX:005930", "primary", 1.0)]), ("b", None, T(2026, 1, 1), "y", [("XKRX:000660", "primary", None)])]), NEWS)
    got = query.on_records(news, query.QuerySpec("s", "news_article", instrument_id="XKRX:005930", columns=["title"])).collect()
    assert [r.title for r in got] == ["x"] and relations.bridge(news).count() == 2


def test_catalog_states(spark):
    row = ("s", "KR", "forum_post", dt.date(2026, 8, 26), "20", "f1", "sha", 5, 100, None, None, 1)
    new = spark.createDataFrame([row, (*row[:5], "f2", *row[6:])], "site_id string, country string, dataset string, partition_date date, bucket string, file_path string, sha256 string, row_count long, file_size long, min_event_time timestamp, max_event_time timestamp, schema_version int")
    files = catalog.upserted(catalog.empty(spark), new)
    assert {(r.id, r.storage_status, r.lifecycle_status) for r in files.collect()} == {(1, "local", "active"), (2, "local", "active")}
    files = catalog.mark_uploaded(files, spark.createDataFrame([("f1", "r1")], "file_path string, remote_path string"))
    again = catalog.upserted(files, new.withColumn("row_count", F.lit(9).cast("long")))
    assert {(r.file_path, r.row_count, r.storage_status, r.id) for r in again.collect()} == {("f1", 9, "uploaded", 1), ("f2", 9, "local", 2)}
    assert catalog.listing(files, "s", "forum_post", buckets=["20"]).count() == 1 and catalog.visible(catalog.mark_superseded(files, ["f1"])).count() == 0
    assert catalog.by_path(catalog.mark_active(catalog.mark_archived(files, ["f1"]), ["f1"]), "f1").first().lifecycle_status == "active"
    with pytest.raises(ValueError):
        catalog.listing(files, "s", "forum_post", first=dt.date(2026, 2, 1), last=dt.date(2026, 1, 1))
    storage = spark.createDataFrame([("r1", 99, "x"), ("orphan", 1, "y")], "path string, size long, sha256 string")
    assert {(r.file_path, r.code) for r in audit.catalog_issues(files, storage).collect()} == {("f1", "file_size_mismatch"), ("f1", "checksum_mismatch"), ("f2", "lifecycle_inconsistent")}
    assert [r.path for r in audit.orphans(files, storage).collect()] == ["orphan"]


def test_compaction(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = lake.canonical(raw(spark, ROWS[:3]), FORUM)
    for crawl in ("2026-09-01", "2026-09-02", "2026-09-03"):
        lake.write_lake(rows.withColumn("crawled_at", F.lit(crawl).cast("timestamp")).withColumn("title", F.concat("title", F.lit(crawl))), FORUM, root)
    files = registered(spark, root)
    out = str(tmp_path / "out")
    plan, after = latest.compact_dataset(spark, files, out, lambda p: lake.files_of(spark.read.option("recursiveFileLookup", True).parquet(p), FORUM).withColumn("sha256", F.lit("x")))
    assert plan.count() == 3 and catalog.visible(after).count() == 3 and after.where("lifecycle_status = 'superseded'").count() == 9
    got = query.on_catalog(spark, after, query.QuerySpec("s", "forum_post")).collect()
    assert len(got) == 3 and all(r.title.endswith("2026-09-03") for r in got)
    assert latest.compact_dataset(spark, files, out, None, dry_run=True)[1] is files


def test_latest_prefers_crawl_over_missing_event(spark):
    rows = spark.createDataFrame([("same", None, T(2026, 9, 8, 1), 1, "old"), ("same", T(2026, 9, 8), T(2026, 9, 8, 2), 2, "new"), ("tie", None, None, 1, "a"), ("tie", None, None, 2, "b")], "record_uid string, event_time timestamp, crawled_at timestamp, pos int, v string").withColumn("updated_at", F.lit(None).cast("timestamp"))
    assert {(r.record_uid, r.v) for r in latest.latest(rows, ["pos"]).collect()} == {("same", "new"), ("tie", "b")}


def test_cdc(spark):
    frame = lambda rows: spark.createDataFrame(rows, "record_uid string, version_hash string, arrival int")
    state = frame([("a", "1", 0), ("b", "1", 0)]).drop("arrival")
    told = cdc.classified(frame([("a", "1", 1), ("b", "2", 2), ("b", "3", 3), ("c", "1", 4)]), state)
    assert {(r.record_uid, r.status) for r in told.collect()} == {("a", "unchanged"), ("b", "updated"), ("c", "new")}
    assert dict(cdc.merged(state, told.where("status <> 'unchanged'"), "arrival").collect()) == {"a": "1", "b": "3", "c": "1"}
    assert cdc.counts(told).first().asDict() == {"seen": 4, "new": 1, "updated": 2, "unchanged": 1}
    assert cdc.not_durable(frame([("a", "1", 0)]), state).isEmpty() and cdc.present(told, state).count() == 3


def test_watermark_and_streaks(spark):
    done = lambda *seqs: [tuple(r)[1:] for r in streaks.contiguous_watermark(spark.createDataFrame([("k", s) for s in seqs], "k string, s long"), ["k"], "s").collect()]
    assert [done(3), done(3, 1), done(3, 1, 2)] == [[(0, 1)], [(1, 1)], [(3, 0)]]
    pages = spark.createDataFrame([("k", p, n) for p, n in enumerate([1, 0, 0, 1, 0, 0, 0])], "k string, p long, n long")
    assert streaks.stopped_at(pages, ["k"], "p", "n").first().stop_page == 6
    spans = spark.createDataFrame([("k", 0, 5), ("k", 5, 6), ("k", 7, 20), ("k", 8, 9)], "k string, a int, b int")
    assert [r.overlaps for r in streaks.overlapping(spans, ["k"], "a", "b").orderBy("a").collect()] == [False, False, True, True]
    ids = spark.createDataFrame([("k", 1, ["a", "b"]), ("k", 2, ["c"]), ("k", 3, ["c"]), ("k", 4, ["a"])], "k string, p int, ids array<string>")
    assert [r.repeats for r in streaks.repeated_page(ids, ["k"], "p", "ids").orderBy("p").collect()] == [False, False, True, True]
    plan = audit.resume_plan(*[spark.createDataFrame(r, s) for r, s in (([("x",), ("y",)], "scope string"), ([("x", True)], "scope string, complete boolean"), ([("x", False, True, False)], "scope string, terminal boolean, retryable boolean, pending boolean"), ([], "scope string, reason string"))])
    assert {tuple(r) for r in plan.collect()} == {("x", "FAILED_RETRYABLE", True), ("y", "INCOMPLETE", True)}


def test_universe_and_index(spark, tmp_path):
    path = tmp_path / "u.txt"
    path.write_text('# metadata: {"count": 2}\n# note\nXKRX:1\n\nXKRX:2\nXKRX:1\n')
    universe = lake.read_universe(spark, str(path))
    assert [r.instrument_id for r in universe.orderBy("pos").collect()] == ["XKRX:1", "XKRX:2"]
    lake.write_universe(universe, str(tmp_path / "v"))
    assert lake.read_universe(spark, str(tmp_path / "v")).count() == 2
    with pytest.raises(ValueError):
        lake.prefix(universe, 3)
    (tmp_path / "i.jsonl").write_text('{"record_uid":"a","version_hash":"1"}\n\n')
    assert lake.read_index(spark, str(tmp_path / "i.jsonl")).count() == 1
    (tmp_path / "j.jsonl").write_text('{"record_uid":"a"}\n')
    with pytest.raises(Exception, match="version_hash"):
        lake.read_index(spark, str(tmp_path / "j.jsonl")).collect()
    with pytest.raises(ValueError):
        lake.export(universe, str(tmp_path / "x.csv"))


def test_stream_replay_changes_nothing(spark, tmp_path):
    rows = lake.canonical(raw(spark, ROWS[:3]), FORUM).withColumn("arrival", F.monotonically_increasing_id())
    rows.write.parquet(str(tmp_path / "in/a"))
    for stage in ("start", "records", "catalog", "state"):
        root, failed = str(tmp_path / f"out-{stage}"), []

        def fault(at, stage=stage, failed=failed):
            if at == stage and not failed:
                failed.append(at)
                raise RuntimeError("injected")

        def run(root=root, fault=fault):
            stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in/*"))
            ingest.ingest(stream, root, f"{root}-checkpoint", fault=fault).awaitTermination()

        with pytest.raises(Exception, match="injected"):
            run()
        run()
        assert ingest.records(spark, root).count() == 3 and ingest.state_before(spark, ingest.Layout(root)).count() == 3
        assert ingest.durable(spark, root, rows)


def test_site_plugins(spark):
    posts = spark.createDataFrame([("1", "005930", "2026-08-24T03:30:00Z", " T ", "a<br>b", "u", "n", "http://x", T(2026, 8, 25))], "nid string, code string, date string, title string, contents string, author_id string, author_name string, url string, crawled_at timestamp")
    r = sites.site("naver_finance").normalize("forum_post", posts).first()
    assert (r.instrument_id, r.content, r.event_time, json.loads(r.payload_json)) == ("XKRX:005930", "a\nb", T(2026, 8, 24, 3, 30), {"code": "005930", "nid": "1"})
    reports = spark.createDataFrame([("5", "00005", "/a.pdf", "24/08/2026 16:30", "Document: Annual", "40100", T(2026, 8, 25)), ("6", "00005", "/a.pdf", "24/08/2026 16:30", "x", "40100", T(2026, 8, 25))], "code string, observed_codes string, pdf_url string, release_time string, title string, report_type string, crawled_at timestamp")
    hk = sites.site("hkexnews")
    r = hk.normalize("financial_report", reports.where("code = '5'")).first()
    assert (r.instrument_id, r.title, r.event_time) == ("XHKG:00005", "Annual", T(2026, 8, 24, 8, 30))
    with pytest.raises(Exception, match="other stock codes"):
        hk.normalize("financial_report", reports.where("code = '6'")).collect()
    months = spark.createDataFrame([(f"http://k/n202401020304{s}", m, "2024-01-02T00:00:00Z", "t", "b", T(2026, 1, 1)) for s, m in (("", "2024-01"), ("", "2024-02"))], "url string, month string, published_at string, title string, body string, crawled_at timestamp")
    assert sites.site("kabutan").normalize("news_article", months).select("record_uid").distinct().count() == 1
    with pytest.raises(ValueError):
        sites.site("nowhere")
    with pytest.raises(ValueError):
        sites.chosen_datasets(hk, ["comment"])
