"""DuckDB twins of the queries."""

from __future__ import annotations


def t(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')"


REC = """ev AS (
    SELECT event_id AS e, event_type AS title, CAST(event_id AS VARCHAR) AS source_id, 'XUSR:' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS instrument_id,
           CAST(ts AS TIMESTAMP) AS event_time, CAST(ts AS TIMESTAMP) + to_days(CAST(event_id % 3 AS INTEGER)) AS crawled_at, props AS payload_json,
           'XUSR:' || lpad(CAST((user_id * 7 + event_id) % 150 AS VARCHAR), 6, '0') AS r1, 'XUSR:' || lpad(CAST((user_id + 1) % 150 AS VARCHAR), 6, '0') AS r2
    FROM events),
rec AS (
    SELECT *, sha256(concat_ws(chr(31), 'events', 'forum_post', 'instrument', instrument_id, source_id)) AS record_uid,
           CASE e % 3 WHEN 0 THEN '' WHEN 1 THEN r1 || ':primary:1.0' ELSE least(r1 || ':primary:1.0', r2 || ':related:0.5') || '|' || greatest(r1 || ':primary:1.0', r2 || ':related:0.5') END AS rel,
           CASE e % 3 WHEN 0 THEN '[]' WHEN 1 THEN '[{"confidence":1.0,"instrument_id":"' || r1 || '","relation_type":"primary"}]'
             ELSE '[{"confidence":1.0,"instrument_id":"' || r1 || '","relation_type":"primary"},{"confidence":0.5,"instrument_id":"' || r2 || '","relation_type":"related"}]' END AS relations_json
    FROM ev)"""
VER = """o AS (SELECT o_orderkey AS k, o_orderstatus AS s, CAST(o_orderdate AS TIMESTAMP) AS t FROM orders),
f AS (SELECT CAST(k AS VARCHAR) AS record_uid, sha256(s) AS version_hash, 1 AS arrival, CASE WHEN k % 5 > 0 THEN t END AS event_time, CASE WHEN k % 7 > 0 THEN t END AS crawled_at FROM o),
g AS (SELECT CAST(k AS VARCHAR) AS record_uid, sha256(CASE WHEN k % 2 = 0 THEN s ELSE s || '!' END) AS version_hash, 2 AS arrival, t AS event_time, t + INTERVAL 1 DAY AS crawled_at FROM o WHERE k % 3 = 0)"""
CAT = """files AS (
    SELECT s_suppkey AS id, 'events' AS site_id, 'US' AS country, CASE WHEN s_suppkey % 2 = 0 THEN 'forum_post' ELSE 'news_article' END AS dataset, DATE '2024-01-01' + CAST(s_nationkey AS INTEGER) AS partition_date,
           lpad(printf('%x', s_suppkey % 2), 2, '0') AS bucket, 'f/' || s_suppkey AS file_path, sha256(CAST(s_suppkey AS VARCHAR)) AS sha256, s_suppkey * 10 AS row_count, s_suppkey * 1000 AS file_size,
           CASE WHEN s_suppkey % 11 = 0 THEN 'local' ELSE 'uploaded' END AS storage_status, CASE WHEN s_suppkey % 13 = 0 THEN 'superseded' ELSE 'active' END AS lifecycle_status,
           CASE WHEN s_suppkey % 17 > 0 THEN 'r/' || s_suppkey END AS remote_path FROM supplier),
store AS (
    SELECT coalesce(remote_path, file_path) AS path, CASE WHEN id % 5 = 0 THEN file_size + 1 ELSE file_size END AS size, CASE WHEN id % 3 = 0 THEN 'x' ELSE sha256 END AS sha FROM files WHERE id % 7 > 0)"""
USERPAGES = "pages_ AS (SELECT user_id, CAST(day(ts) AS BIGINT) AS page, count(*) FILTER (event_type = 'purchase') AS n_new FROM events GROUP BY ALL)"
RUNS = """s AS (SELECT 'site' || (user_id % 3) AS site_id, event_type AS dataset, count(*) AS total, count(*) FILTER (event_id % 3 = 0) AS durable, count(*) FILTER (event_id % 3 = 1) AS runtime_done,
           count(*) FILTER (event_id % 97 = 0) AS running, count(*) FILTER (event_id % 1009 = 2) AS blocked, count(*) FILTER (event_id % 2003 = 5) AS failed, CAST(sum(user_id) AS BIGINT) AS records,
           count(DISTINCT user_id) AS files, CAST(sum(event_id) AS BIGINT) AS bytes FROM events GROUP BY ALL),
d AS (SELECT *, least(total, durable + runtime_done) AS completed FROM s),
ds AS (SELECT *, CASE WHEN failed > 0 THEN 'failed' WHEN blocked > 0 AND running = 0 THEN 'blocked' WHEN total > 0 AND completed >= total THEN 'complete'
           WHEN running > 0 OR runtime_done > 0 THEN 'running' ELSE 'pending' END AS status FROM d)"""
UNI = "u AS (SELECT min(c_custkey) AS pos, 'XNAT:' || (c_nationkey * 100 + c_custkey % 20) AS instrument_id FROM customer GROUP BY 2)"
BUCKET = "('0x' || substr(sha1({}), 1, 16))::UBIGINT % {}"
COLS = f"record_uid, instrument_id, {t('event_time')} AS event_time, title"
SEOUL = "event_time >= TIMESTAMP '2024-01-04 15:00:00' AND event_time < TIMESTAMP '2024-01-07 15:00:00'"
WS = r"[\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def unescaped(c: str) -> str:
    for a, b in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"), ("&apos;", "''''"), ("&amp;", "'&'")):
        c = f"replace({c}, '{a}', {b})"
    return c


def one_line(c: str) -> str:
    return strip(f"regexp_replace({unescaped(c)}, '{WS}+', ' ', 'g')")


def lines(c: str, each: str) -> str:
    return f"array_to_string(list_filter(list_transform(string_split_regex({c}, '\\r\\n|[\\n\\r]'), lambda x: {each}), lambda x: x <> ''), chr(10))"


MESSY = "chr(12288) || '<b>' || text || '</b> <br/>  x &amp; y' || repeat(chr(10), 4) || ' z  '"
PLAIN = lines(f"replace({unescaped(f"regexp_replace(regexp_replace({MESSY}, '<br\\s*/?>', chr(10), 'gi'), '<[^>]+>', '', 'g')")}, chr(160), ' ')", strip("x"))
def article(inner: str) -> str:
    """Text of a page's part: a line for each block, tags gone."""
    text = unescaped(f"regexp_replace(regexp_replace(regexp_replace({inner}, '<!--.*?-->', '', 'gs'), '<(br|p|div|li|tr)\\b[^>]*>', chr(10), 'gi'), '<[^>]*>', '', 'g')")
    return lines(text, strip(f"regexp_replace(x, '{WS}+', ' ', 'g')"))


BODY = "regexp_replace(regexp_extract(html, '<body[^>]*>(.*)', 1, 's'), '<(script|style|nav|footer)\\b.*?</(script|style|nav|footer)>', '', 'gs')"
LINK = r"""<a\b[^>]*?\bhref\s*=\s*[\"'']([^\"'']*)[\"''][^>]*>(.*?)</a>"""
CUSTOMER_RETENTION = "SELECT o_orderkey, k, CASE WHEN k % 3 = 0 THEN 'manifest' WHEN k % 3 = 1 THEN 'sidecar' ELSE 'parquet' END AS kind, k % 2 = 0 AS superseded, k % 60 AS age, k % 7 > 0 AS durable, k % 11 = 0 AS failed FROM (SELECT o_orderkey, o_orderkey AS k FROM orders)"

SQL: dict[str, str] = {
    "q_canonical_projection": f"WITH {REC} SELECT record_uid, 'events' AS site_id, 'US' AS country, 'forum_post' AS dataset, source_id, 'instrument' AS scope_type, instrument_id AS scope_id, instrument_id, {t('event_time')} AS event_time, {t('crawled_at')} AS crawled_at, title, payload_json, relations_json, CAST(1 AS INTEGER) AS schema_version, 'versioned' AS mutation_policy FROM rec",
    "q_record_uid": f"WITH {REC} SELECT source_id, record_uid FROM rec",
    "q_version_hash": f"WITH {REC} SELECT record_uid, sha256(concat_ws(chr(31), 'events', 'forum_post', source_id, 'instrument', instrument_id, instrument_id, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ'), '', title, '', '', '', '', rel, payload_json)) AS version_hash FROM rec",
    "q_instrument_bucket": f"WITH {REC} SELECT instrument_id, count(*) AS n, printf('%02x', CAST({BUCKET.format('instrument_id', 256)} AS BIGINT)) AS bucket, CAST({BUCKET.format('instrument_id', 7)} AS BIGINT) AS bucket7, CAST({BUCKET.format('instrument_id', 1000)} AS BIGINT) AS bucket1000, printf('%03x', CAST({BUCKET.format('instrument_id', 1000)} AS BIGINT)) AS label1000 FROM rec GROUP BY instrument_id",
    "q_partition_layout": f"WITH {REC} SELECT 'site=events/country=US/dataset=forum_post/' || strftime(event_time, 'year=%Y/month=%m/day=%d') || '/bucket=' || printf('%02x', CAST({BUCKET.format('instrument_id', 256)} AS BIGINT)) AS path, count(*) AS n FROM rec GROUP BY 1",
    "q_year_partitions": "SELECT strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year_start, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, count(*) AS n FROM orders GROUP BY ALL",
    "q_filter_instrument_date_tz": f"WITH {REC} SELECT {COLS} FROM rec WHERE instrument_id IN ('XUSR:000008', 'XUSR:000046') AND {SEOUL}",
    "q_multi_instrument": f"WITH {REC} SELECT {COLS} FROM rec WHERE instrument_id < 'XUSR:000100' AND event_time >= TIMESTAMP '2024-01-10'",
    "q_record_uid_lookup": f"WITH {REC} SELECT {COLS} FROM rec WHERE e = 42",
    "q_relation_filter": f"WITH {REC} SELECT sha256(concat_ws(chr(31), 'events', 'news_article', 'instrument', instrument_id, source_id)) AS record_uid, instrument_id, {t('event_time')} AS event_time, title FROM rec WHERE instrument_id IN ('XUSR:000003', 'XUSR:000077') OR (e % 3 > 0 AND r1 IN ('XUSR:000003', 'XUSR:000077')) OR (e % 3 = 2 AND r2 IN ('XUSR:000003', 'XUSR:000077'))",
    "q_relation_bridge": f"WITH {REC}, l AS (SELECT record_uid, r1 AS instrument_id, 'primary' AS relation_type, 1.0::DOUBLE AS confidence FROM rec WHERE e % 3 > 0 UNION ALL SELECT record_uid, r2, 'related', 0.5::DOUBLE FROM rec WHERE e % 3 = 2) SELECT DISTINCT * FROM l",
    "q_pruned_equals_full": f"WITH {REC} SELECT {COLS} FROM rec WHERE instrument_id IN ('XUSR:000008', 'XUSR:000046', 'XUSR:000011') AND {SEOUL}",
    "q_catalog_query": f"WITH {REC} SELECT {COLS} FROM rec WHERE instrument_id IN ('XUSR:000008', 'XUSR:000046') AND {SEOUL}",
    "q_topn_ordered": f"WITH {REC}, r AS (SELECT * FROM rec ORDER BY event_time, record_uid LIMIT 50) SELECT {COLS} FROM r",
    "q_cdc_classify": f"WITH {VER}, i AS (SELECT record_uid, version_hash FROM g UNION ALL SELECT 'c' || c_custkey, 'x' FROM customer) SELECT CASE WHEN f.record_uid IS NULL THEN 'new' WHEN f.version_hash = i.version_hash THEN 'unchanged' ELSE 'updated' END AS status, count(*) AS n FROM i LEFT JOIN f USING (record_uid) GROUP BY 1",
    "q_cdc_state_after": f"WITH {VER} SELECT f.record_uid, coalesce(g.version_hash, f.version_hash) AS version_hash FROM f LEFT JOIN g USING (record_uid)",
    "q_cdc_not_durable": f"WITH {VER} SELECT record_uid, version_hash FROM g EXCEPT SELECT record_uid, version_hash FROM f",
    "q_catalog_listing": f"WITH {CAT} SELECT id, strftime(partition_date, '%Y-%m-%d') AS day, bucket FROM files WHERE dataset = 'forum_post' AND storage_status = 'uploaded' AND lifecycle_status = 'active' AND partition_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AND bucket IN ('00', '1f')",
    "q_catalog_upsert": f"WITH {CAT} SELECT file_path, CASE WHEN id % 4 = 0 THEN row_count + 1 ELSE row_count END AS row_count, storage_status, CASE WHEN id IN (1, 2) THEN 'archived' ELSE lifecycle_status END AS lifecycle_status FROM files UNION ALL SELECT 'new/' || id, row_count, 'local', 'active' FROM files WHERE id % 10 = 0",
    "q_compaction_plan": f"WITH {CAT} SELECT site_id, country, dataset, strftime(partition_date, '%Y-%m-%d') AS day, bucket, count(*) AS n_files, CAST(sum(row_count) AS BIGINT) AS n_rows, CAST(sum(file_size) AS BIGINT) AS n_bytes, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS file_ids FROM files WHERE storage_status = 'uploaded' AND lifecycle_status = 'active' GROUP BY site_id, country, dataset, partition_date, bucket HAVING count(*) >= 2",
    "q_latest_version": f"WITH {VER}, b AS (SELECT * FROM f UNION ALL SELECT * FROM g), r AS (SELECT *, row_number() OVER (PARTITION BY record_uid ORDER BY coalesce(crawled_at, event_time) DESC NULLS LAST, arrival DESC) AS n FROM b) SELECT record_uid, version_hash, {t('event_time')} AS event_time, {t('crawled_at')} AS crawled_at FROM r WHERE n = 1",
    "q_compaction_summary": f"WITH {VER}, b AS (SELECT * FROM f UNION ALL SELECT * FROM g) SELECT count(*) AS rows_before, count(DISTINCT record_uid) AS rows_after, count(DISTINCT record_uid) AS keys, count(*) - count(DISTINCT record_uid) AS removed, CAST(0 AS BIGINT) AS duplicates_left FROM b",
    "q_contiguous_watermark": "WITH d AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS seq FROM lineitem WHERE l_linenumber <> 3 OR l_orderkey % 2 = 0), n AS (SELECT *, seq - row_number() OVER (PARTITION BY l_orderkey ORDER BY seq) AS gap FROM d) SELECT l_orderkey, CAST(coalesce(max(seq) FILTER (gap = 0), 0) AS BIGINT) AS watermark, count(*) FILTER (gap <> 0) AS n_pending FROM n GROUP BY l_orderkey",
    "q_stop_rule_streak": f"WITH {USERPAGES}, p AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY page) AS part FROM pages_), q AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, part ORDER BY page) AS streak FROM p) SELECT user_id, min(page) FILTER (streak >= 2) AS stop_page, count(*) AS n_pages FROM q GROUP BY user_id",
    "q_quiet_streak": f"WITH {USERPAGES}, p AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY page) AS part FROM pages_) SELECT user_id, page, n_new, CAST(sum(CASE WHEN n_new > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, part ORDER BY page) AS BIGINT) AS streak FROM p",
    "q_interval_overlap": "WITH o AS (SELECT o_custkey, o_orderkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS a FROM orders), i AS (SELECT *, a + o_orderkey % 60 + 1 AS b FROM o) SELECT o_orderkey, EXISTS (SELECT 1 FROM i y WHERE y.o_custkey = x.o_custkey AND y.o_orderkey <> x.o_orderkey AND y.a < x.b AND x.a < y.b) AS overlaps FROM i x",
    "q_audit_issues": f"WITH {CAT}, m AS (SELECT files.*, store.path, store.size, store.sha, storage_status = 'uploaded' AS up, lifecycle_status = 'active' AS act, coalesce(remote_path, '') = '' AS bare FROM files LEFT JOIN store ON store.path = coalesce(files.remote_path, files.file_path)), x AS (SELECT *, up AND NOT (act AND bare) AS found FROM m) SELECT file_path, 'lifecycle_inconsistent' AS code FROM x WHERE act AND NOT up UNION ALL SELECT file_path, 'missing_remote_path' FROM x WHERE act AND up AND bare UNION ALL SELECT file_path, 'remote_file_missing' FROM x WHERE found AND path IS NULL UNION ALL SELECT file_path, 'file_size_mismatch' FROM x WHERE found AND size <> file_size UNION ALL SELECT file_path, 'checksum_mismatch' FROM x WHERE found AND sha <> sha256",
    "q_orphans": f"WITH {CAT} SELECT path, 'warning' AS severity FROM store WHERE path NOT IN (SELECT coalesce(remote_path, file_path) FROM files WHERE id % 9 > 0)",
    "q_completeness": "WITH e AS (SELECT o_orderpriority AS dataset, count(DISTINCT o_custkey) AS n_expected, count(DISTINCT o_custkey) FILTER (o_orderstatus <> 'F') AS n_completed, count(*) FILTER (o_orderkey % 100 = 0 AND o_orderkey % 200 <> 0 AND o_orderkey % 300 <> 0) AS n_pending, count(*) FILTER (o_orderkey % 100 = 0 AND o_orderkey % 200 <> 0 AND o_orderkey % 300 = 0) AS n_failed FROM orders GROUP BY 1) SELECT *, greatest(n_expected - n_completed, 0) AS n_missing, n_expected <= n_completed AND n_pending = 0 AND n_failed = 0 AS is_complete FROM e",
    "q_month_status": "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, max(o_orderkey) AS k FROM orders GROUP BY 1) SELECT CASE WHEN k % 5 = 0 THEN 'missing' WHEN k % 4 = 0 THEN 'natural' WHEN k % 4 = 1 THEN 'free_access' WHEN k % 4 = 2 THEN 'failed' ELSE 'partial' END AS status, count(*) AS n FROM m GROUP BY 1",
    "q_progress_rollup": f"WITH {RUNS} SELECT site_id, dataset, CASE grouping(site_id, dataset) WHEN 3 THEN 'platform' WHEN 1 THEN 'site' ELSE 'dataset' END AS level, CAST(sum(total) AS BIGINT) AS total, CAST(sum(completed) AS BIGINT) AS completed, CAST(sum(records) AS BIGINT) AS records, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'blocked') AND bool_and(status IN ('blocked', 'complete')) THEN 'blocked' WHEN sum(completed) >= sum(total) THEN 'complete' WHEN bool_or(status = 'running') THEN 'running' ELSE 'pending' END AS status, round(sum(completed) * 100.0::DOUBLE / sum(total), 2) AS percent FROM ds GROUP BY ROLLUP (site_id, dataset)",
    "q_progress_datasets": f"WITH {RUNS} SELECT site_id, dataset, completed, greatest(total - completed, 0) AS remaining, round(completed * 100.0::DOUBLE / total, 2) AS percent, status, round(records / 60.0::DOUBLE, 4) AS records_per_second FROM ds",
    "q_file_size_summary": f"WITH {CAT} SELECT count(*) AS n_files, CAST(sum(file_size) AS BIGINT) AS n_bytes, CAST(sum(row_count) AS BIGINT) AS n_rows, min(file_size) AS least_bytes, max(file_size) AS most_bytes FROM files",
    "q_retention": f"WITH r AS ({CUSTOMER_RETENTION}) SELECT o_orderkey, CASE WHEN failed OR NOT durable OR (kind <> 'parquet' AND age < 30) OR (superseded AND age < 7) THEN 'keep' WHEN superseded THEN 'archive' ELSE 'delete' END AS decision, false AS allowed, CASE WHEN failed THEN 'failed artifact retained for inspection' WHEN NOT durable THEN 'durability barrier incomplete' WHEN kind <> 'parquet' AND age < 30 THEN 'manifest retention window not elapsed' WHEN superseded AND age < 7 THEN 'superseded rollback window not elapsed' WHEN superseded THEN 'archive superseded artifact before deletion' ELSE 'dry-run deletion candidate' END AS reason FROM r",
    "q_cleanup_gate": "WITH r AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'remote upload not completed' WHEN o_orderkey % 3 = 0 THEN 'remote verification not completed' WHEN o_orderkey % 5 = 0 THEN 'postgres catalog not registered' WHEN o_orderkey % 7 = 0 THEN 'seen store not committed' WHEN o_orderkey % 11 = 0 THEN 'checkpoint not committed' ELSE 'safe to delete' END AS reason FROM orders) SELECT reason = 'safe to delete' AS can_delete, reason, count(*) AS n FROM r GROUP BY ALL",
    "q_resume_classify": "WITH r AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'BLOCKED' WHEN o_orderkey % 11 = 0 THEN 'FAILED_TERMINAL' WHEN o_orderkey % 7 = 0 THEN 'FAILED_RETRYABLE' WHEN o_orderkey % 5 = 0 THEN 'RECOVERY_PENDING' WHEN o_orderkey % 2 = 0 THEN 'DURABLE_COMPLETE' ELSE 'INCOMPLETE' END AS status FROM orders) SELECT status, count(*) AS n, count(*) FILTER (status IN ('INCOMPLETE', 'FAILED_RETRYABLE')) AS n_crawl FROM r GROUP BY 1",
    "q_retry_classify": "WITH r AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'Read TIMED OUT' WHEN 1 THEN 'sha256 mismatch after timeout' WHEN 2 THEN 'database is locked' WHEN 3 THEN 'odd' END AS error, o_orderkey % 4 AS retries FROM orders) SELECT error, retries, CASE WHEN error LIKE 'sha%' THEN 'stop' WHEN retries >= 3 THEN 'stop' WHEN error LIKE 'Read%' OR error LIKE 'data%' THEN 'retry' ELSE 'stop' END AS decision, CASE WHEN error LIKE 'sha%' THEN 'non_retryable_error' WHEN retries >= 3 THEN 'max_retries_exceeded' WHEN error LIKE 'Read%' OR error LIKE 'data%' THEN 'retryable_error' ELSE 'non_retryable_error' END AS reason, count(*) AS n FROM r GROUP BY ALL",
    "q_recovery_actions": "WITH r AS (SELECT o_orderkey AS k, ['local', 'uploaded', 'verified', 'catalog_registered', 'seen_committed', 'checkpoint_committed', 'cleanable', 'deleted', 'failed'][o_orderkey % 9 + 1] AS stage FROM orders) SELECT stage, CASE stage WHEN 'local' THEN 'upload_and_verify' WHEN 'uploaded' THEN 'verify_remote' WHEN 'verified' THEN 'register_catalog' WHEN 'catalog_registered' THEN 'commit_seen' WHEN 'seen_committed' THEN 'advance_checkpoint_marker' WHEN 'checkpoint_committed' THEN 'clean_local' WHEN 'cleanable' THEN 'clean_local' WHEN 'deleted' THEN 'none' ELSE CASE WHEN k % 2 = 0 THEN 'retry' ELSE 'stop_terminal' END END AS action, count(*) AS n FROM r GROUP BY ALL",
    "q_rollout_gate": f"WITH {RUNS}, r AS (SELECT site_id, dataset, list_filter([CASE WHEN files < 1 THEN 'instrument_count must be >= 1' END, CASE WHEN total < 1 THEN 'attempted_scopes must be >= 1' END, CASE WHEN (failed + blocked * 20) / total > 0.02 THEN 'scope failure rate exceeded threshold' END, CASE WHEN failed > 0 THEN 'recovery failures remain' END, CASE WHEN blocked > 0 THEN 'pending recovery remains' END, CASE WHEN bytes * 100 > 536870912 THEN 'file size threshold exceeded' END], lambda x: x IS NOT NULL) AS why FROM ds) SELECT site_id, dataset, len(why) = 0 AS can_expand, array_to_string(why, '; ') AS reasons FROM r",
    "q_set_reconcile": "WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT o_custkey AS k FROM orders WHERE o_custkey % 10 > 2 UNION SELECT o_custkey + 1000000 FROM orders WHERE (o_custkey + 1000000) % 50 = 0) SELECT k, 'missing' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'unexpected' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)",
    "q_path_overlap": f"WITH {CAT} SELECT file_path FROM files WHERE id % 6 = 0",
    "q_clean_text": f"SELECT doc_id, nullif({PLAIN}, '') AS plain, {one_line(MESSY)} AS line, {lines("translate(text, chr(160) || chr(12288), '  ')", strip("regexp_replace(x, '[ \\t]+', ' ', 'g')"))} AS lines, {strip(MESSY)} AS stripped FROM documents",
    "q_parse_int": r"SELECT doc_id, CASE WHEN doc_id = 0 THEN 0 ELSE -doc_id * 12345 END AS a, try_cast(nullif(regexp_extract(replace(text, ',', ''), '\d+'), '') AS BIGINT) AS b, CAST(0 AS BIGINT) AS c FROM documents",
    "q_research_date": "WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) + CASE WHEN o_orderkey % 50 = 0 THEN 20 ELSE 0 END AS d FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE strftime(try_cast(printf('%04d-%02d-%02d', CASE WHEN o_orderkey % 4 = 2 THEN 2000 + y % 100 ELSE y END, m, d) AS DATE), '%Y-%m-%d') END AS d FROM d",
    "q_relative_time": f"SELECT event_id, {t("CASE event_id % 5 WHEN 0 THEN CAST(ts AS TIMESTAMP) - to_minutes(event_id % 50) WHEN 1 THEN CAST(ts AS TIMESTAMP) - to_hours(event_id % 20) WHEN 2 THEN CAST(ts AS TIMESTAMP) - to_days(CAST(event_id % 9 AS INTEGER)) WHEN 3 THEN CAST(ts AS TIMESTAMP) END")} AS event_time, CASE WHEN event_id % 5 = 4 THEN 'unknown' ELSE 'approximate_relative' END AS quality FROM events",
    "q_hkex_codes": "SELECT p_partkey, array_to_string(list_filter([lpad(CAST(p_partkey AS VARCHAR), 5, '0'), lpad('8' || (p_partkey % 10000), 5, '0')], lambda x, i: i = 1 OR lpad('8' || (p_partkey % 10000), 5, '0') <> lpad(CAST(p_partkey AS VARCHAR), 5, '0')), ',') AS codes, 'XHKG:' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS instrument FROM part",
    "q_url_ids": r"SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm, CAST(page_id AS VARCHAR) AS nid, lpad(CAST(page_id AS VARCHAR), 6, '0') AS code, sha256(url) AS news_id, replace(regexp_replace(url, '[^\p{L}\p{N}_.:-]', '_', 'g'), '..', '_') AS safe FROM pages",
    "q_html_links": f"WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1, 'si')) AS href, unnest(regexp_extract_all(html, '{LINK}', 2, 'si')) AS txt, unnest(range(len(regexp_extract_all(html, '{LINK}', 1, 'si')))) AS pos FROM pages), c AS (SELECT page_id, href, pos, {one_line("regexp_replace(txt, '<[^>]*>', ' ', 'g')")} AS title FROM l) SELECT page_id, href, arg_min(title, pos) AS title FROM c WHERE length(title) >= 1 GROUP BY page_id, href",
    "q_html_title": f"SELECT page_id, nullif({one_line("regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'si'), '<[^>]*>', ' ', 'g')")}, '') AS title FROM pages",
    "q_html_rows": "SELECT page_id, CAST(0 AS BIGINT) AS pos, 'id|' || page_id AS cells FROM pages UNION ALL SELECT page_id, 1, 'a b' FROM pages",
    "q_html_article": f"WITH a AS (SELECT page_id, {article("regexp_extract(html, '<article[^>]*>(.*?)</article>', 1, 's')")} AS t, {article(BODY)} AS b FROM pages), c AS (SELECT page_id, CASE WHEN length(t) >= 100 THEN t WHEN length(b) >= 100 THEN b END AS body FROM a) SELECT page_id, CAST(length(body) AS INTEGER) AS n, sha256(body) AS sha FROM c",
    "q_month_windows": "WITH o AS (SELECT o_orderpriority, date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders GROUP BY 1), m AS (SELECT o_orderpriority, unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m FROM o) SELECT o_orderpriority, strftime(m, '%Y-%m') AS month, strftime(m - INTERVAL 1 MONTH, '%Y-%m') AS before FROM m",
    "q_universe_prefix": f"WITH {UNI}, r AS (SELECT *, row_number() OVER (ORDER BY pos) AS n FROM u) SELECT CAST(s AS INTEGER) AS stage_size, instrument_id, pos FROM r, (VALUES (10), (50)) v(s) WHERE n <= s",
    "q_universe_page": f"WITH {UNI} SELECT pos, instrument_id FROM u ORDER BY pos LIMIT 30 OFFSET 20",
    "q_bridge_join": "SELECT p_type AS kind, count(DISTINCT l_orderkey) AS n_records, count(*) AS n_links FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
    "q_detail_merge": "SELECT i.conv_id, coalesce(CASE WHEN d.conv_id % 2 = 0 THEN d.role END, i.role) AS role, CAST(length(i.text) AS INTEGER) AS n, sha256(d.text) AS sha FROM conversations i LEFT JOIN conversations d ON d.conv_id = i.conv_id AND d.turn = 1 WHERE i.turn = 0",
    "q_last_per_key": f"WITH {VER} SELECT f.record_uid, coalesce(g.version_hash, f.version_hash) AS version_hash FROM f LEFT JOIN g USING (record_uid)",
    "q_counter_delta": "SELECT event_id, event_id * 3 - coalesce(lag(event_id * 3) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS delta FROM events",
    "q_estimated_bytes": """SELECT o_orderkey, CAST(strlen('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","x":null}') AS BIGINT) AS n FROM orders""",
    "q_stream_dedup": f"WITH {REC} SELECT record_uid, sha256(concat_ws(chr(31), 'events', 'forum_post', source_id, 'instrument', instrument_id, instrument_id, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ'), '', title, '', '', '', '', rel, payload_json)) AS version_hash FROM rec",
    "q_export_roundtrip": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "q_index_roundtrip": f"WITH {REC} SELECT record_uid, sha256(concat_ws(chr(31), 'events', 'forum_post', source_id, 'instrument', instrument_id, instrument_id, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ'), '', title, '', '', '', '', rel, payload_json)) AS version_hash FROM rec",
    "q_union_promoted": "SELECT s_suppkey AS k, s_nationkey AS n, NULL::VARCHAR AS m FROM supplier UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer",
    "q_unique_files": f"WITH {CAT} SELECT id, file_path FROM files",
}
