"""Queries over functions of values: identifiers, addresses, texts, dates, rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import dates, identity, rules, sites, text
from .model import DATASETS, SchemaRegistry, spec_of
from .operators import streaks
from .plans import sites as plugins
from .registry import Registry, table

R = Registry()
QUERIES, SQL, twin = R.queries, R.sql, R.twin
SIX = "lpad(CAST(p_partkey AS VARCHAR), 6, '0')"


@twin(f"SELECT p_partkey, {SIX} AS code, CASE WHEN p_partkey % 3 < 2 THEN 'XKRX:' || {SIX} END AS instrument, CASE WHEN p_partkey % 3 < 2 THEN true ELSE false END AS canonical, 'https://finance.naver.com/item/news_news.naver?code=' || {SIX} || '&page=' || (p_size + 1) AS list_url, 'https://n.news.naver.com/mnews/article/' || p_size || '/' || p_partkey AS article_url FROM (SELECT p_partkey, p_size FROM part)".replace("SELECT p_partkey, lpad", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN p_partkey || 'x' ELSE lpad", 1).replace("'0') AS code", "'0') END AS code", 1))
def q_naver_ids(spark, sf_dir):
    k, six = F.col("p_partkey"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")
    raw = F.when(k % 3 == 0, F.concat(F.lit(" xkrx:"), six)).when(k % 3 == 1, six).otherwise(F.concat(k, F.lit("x")))
    own = sites.naver_instrument(raw)
    return table(spark, sf_dir, "part").select("p_partkey", sites.naver_code(raw).alias("code"), own.alias("instrument"), F.coalesce(sites.is_canonical(own), F.lit(False)).alias("canonical"), sites.news_list_url(six, F.col("p_size") + 1).alias("list_url"), sites.naver_news_url(F.col("p_size"), k).alias("article_url"))


@twin("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN 'https://www1.hkexnews.hk/l/' || o_orderkey || '.PDF' || CASE WHEN o_orderkey % 4 = 1 THEN '?v=1' ELSE '' END END AS url, CASE WHEN o_orderkey % 4 < 3 THEN sha256('https://www1.hkexnews.hk/l/' || o_orderkey || '.PDF' || CASE WHEN o_orderkey % 4 = 1 THEN '?v=1' ELSE '' END) END AS source_id, ['annual', 'interim', 'quarterly', NULL][o_orderkey % 4 + 1] AS kind, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate + to_minutes(o_orderkey % 60) + INTERVAL 8 HOUR - INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S.%f') END AS released, 'Report ' || o_orderkey AS title FROM orders")
def q_hkex_fields(spark, sf_dir):
    k, when = F.col("o_orderkey"), F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(8), (F.col("o_orderkey") % 60).cast("int"))
    url = F.when(k % 4 == 0, F.concat(F.lit("/a/../l/"), k, F.lit(".PDF"))).when(k % 4 == 1, F.concat(F.lit("HTTPS://WWW1.hkexnews.hk/l/"), k, F.lit(".PDF?v=1#p2"))).when(k % 4 == 2, F.concat(F.lit("l/./"), k, F.lit(".PDF"))).otherwise(F.concat(F.lit("https://evil.example/"), k, F.lit(".pdf")))
    kind = F.element_at(F.array(F.lit("Annual "), F.lit("40200"), F.lit("quarterly"), F.lit("weekly")), (k % 4 + 1).cast("int"))
    said = F.when(k % 3 == 0, F.date_format(when, "dd/MM/yyyy HH:mm")).when(k % 3 == 1, F.date_format(when, "yyyy 年 M 月 d 日 H:mm")).otherwise(F.lit("soon"))
    return table(spark, sf_dir, "orders").select("o_orderkey", sites.hkex_pdf_url(url).alias("url"), sites.hkex_source_id(url).alias("source_id"), sites.hkex_report_type(kind)["name"].alias("kind"), F.date_format(dates.hong_kong_time(said), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("released"), text.labelled(F.concat(F.lit(" document :  Report  "), k), "Document").alias("title"))


@twin("SELECT event_id, CASE WHEN event_id % 4 < 3 THEN lpad(CAST(user_id AS VARCHAR), 6, '0') END AS symbol, CASE WHEN event_id % 4 < 3 THEN 'XKRX:' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS instrument, CASE WHEN event_id % 4 = 0 THEN 'https://www.tossinvest.com/stocks/A' || lpad(CAST(user_id AS VARCHAR), 6, '0') || '/order' END AS stock_url, strftime(ts, '%Y-%m-%d') AS day, ['서울경제', '연합뉴스', ''][event_id % 3 + 1] AS publisher, event_id % 5 < 2 AS generic, 'body ' || event_id AS content, sha256('a|' || event_id || '|') AS content_id, 'toss|forum_post|instrument|' || user_id AS token FROM events")
def q_toss_fields(spark, sf_dir):
    k, six = F.col("event_id"), F.lpad(F.col("user_id").cast("string"), 6, "0")
    raw = F.when(k % 4 == 0, F.concat(F.lit("A"), six)).when(k % 4 == 1, F.concat(F.lit("XKRX:"), six)).when(k % 4 == 2, F.concat(F.lit("​"), six)).otherwise(F.concat(F.lit("B"), six))
    news_id = F.concat(F.element_at(F.array(F.lit("Sedaily_"), F.lit("yna_"), F.lit("other_")), (k % 3 + 1).cast("int")), F.date_format("ts", "yyyyMMdd"), k)
    title = F.when(k % 5 == 0, F.lit("Toss Invest")).when(k % 5 == 1, F.lit("s 뉴스")).otherwise(F.concat(F.lit("news "), k))
    return table(spark, sf_dir, "events").select(
        "event_id", sites.toss_symbol(raw).alias("symbol"), sites.toss_instrument(raw).alias("instrument"), sites.toss_stock(raw, F.lit("s"), F.lit(""))["stock_url"].alias("stock_url"), sites.toss_news_date(news_id).alias("day"), sites.toss_publisher(news_id).alias("publisher"), sites.is_generic_title(title, F.lit("s")).alias("generic"),
        text.before_marker(F.concat(F.lit("body "), k, F.lit("\n관련 주식\nmore")), sites.SECTIONS).alias("content"), identity.content_id(F.lit("a"), k, F.lit(None)).alias("content_id"), identity.scope_token(F.lit("toss"), F.lit("forum_post"), F.lit("instrument"), F.col("user_id").cast("string")).alias("token"),
    )


@twin("SELECT o_orderkey, 'n' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS news_id, ' {\"k\":' || o_orderkey || '} ' AS json, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y%m%d') END AS compact, o_orderkey % 4 = 0 AS human, 'Inst' || o_orderkey AS institution, 'a b ' || chr(10) || chr(10) || 'c' || o_orderkey AS body FROM orders")
def q_kabutan_ids(spark, sf_dir):
    k = F.col("o_orderkey")
    raw_day = F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.lit("never"))
    page = F.when(k % 4 < 2, F.lit("<p>Human Verification</p><script>gokuProps</script>")).when(k % 4 == 2, F.lit("an article on Human Verification")).otherwise(F.lit("x"))
    status = F.when(k % 2 == 0, 405).otherwise(200)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", sites.kabutan_news_id(F.concat(F.lit("https://kabutan.jp/news/marketnews/?b=n"), F.lpad(k.cast("string"), 12, "0"), F.lit("&c=1"))).alias("news_id"), sites.jsonp_body(F.concat(F.lit(" call.back1 ( {\"k\":"), k, F.lit("} ) ; "))).alias("json"), dates.compact_date(raw_day).alias("compact"),
        sites.is_human_check(status, page).alias("human"), text.first_plain_part(F.concat(F.lit("2024.01.02 | 조회 5 | Inst"), k, F.lit(" | x"))).alias("institution"), text.paragraphs(F.concat(F.lit("a&nbsp; b \n\n\n\n  c"), k)).alias("body"),
    )


@twin("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 = 4 THEN 0 ELSE o_orderkey % 5 + 1 END AS INTEGER) AS n_days, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)), '%Y-%m-%d') END AS last_day, strftime(o_orderdate - CASE WHEN o_orderkey % 3 = 1 THEN INTERVAL 9 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%dT%H:%M:%S') AS utc FROM orders")
def q_day_series(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    days = dates.day_series(d, F.date_add(d, F.when(k % 5 == 4, -1).otherwise(k % 5).cast("int")))
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(k % 3 == 0, "Z").when(k % 3 == 1, "+09:00").otherwise(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(days).alias("n_days"), F.date_format(F.try_element_at(days, F.lit(-1)), "yyyy-MM-dd").alias("last_day"), F.date_format(dates.iso_time(iso), "yyyy-MM-dd'T'HH:mm:ss").alias("utc"))


@twin("SELECT s_suppkey, 'events' AS site, 'f' || s_suppkey % 4 AS dataset, strftime(DATE '2024-01-01' + CAST(s_suppkey % 31 AS INTEGER), '%d') AS day, CASE WHEN s_suppkey % 5 = 0 THEN 'bucket' ELSE '' END AS missing FROM supplier")
def q_partition_keys(spark, sf_dir):
    k = F.col("s_suppkey")
    day = F.expr("date_add(date'2024-01-01', cast(s_suppkey % 31 as int))")
    path = identity.partition_path(F.lit("events"), F.lit("US"), F.concat(F.lit("f"), k % 4), day, F.lit("0a"))
    path = F.concat(F.lit("/lake/"), F.when(k % 5 == 0, F.regexp_replace(path, "/bucket=.*", "")).otherwise(path), F.lit("/part-0.parquet"))
    parts = identity.parsed_path(path)
    return table(spark, sf_dir, "supplier").select("s_suppkey", parts["site"].alias("site"), parts["dataset"].alias("dataset"), parts["day"].alias("day"), F.array_join(identity.missing_keys(path), ",").alias("missing"))


@twin("SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 ELSE 0 END) AS BIGINT) AS uploaded, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS verified FROM orders GROUP BY 1")
def q_upload_flags(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "uploaded").when(F.col("o_orderstatus") == "O", "verified").otherwise("dry_run")
    up, ok = rules.upload_flags(status)
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum(up.cast("long")).alias("uploaded"), F.sum(ok.cast("long")).alias("verified"))


@twin("SELECT o_orderkey, o_orderkey % 9 <= o_custkey % 9 OR o_custkey % 9 = 8 AS allowed, o_orderkey % 4 = 0 OR o_orderkey % 4 = 1 AS durable FROM orders")
def q_stage_moves(spark, sf_dir):
    at = lambda c: F.element_at(F.array(*[F.lit(s) for s in rules.STAGES]), (c % 9 + 1).cast("int"))
    k = F.col("o_orderkey")
    state = F.when(k % 4 == 0, '{"month_complete":true,"archive_access_validated":true}').when(k % 4 == 1, '{"free_access_complete":true,"stop_reason":"free_access_boundary"}').when(k % 4 == 2, '{"month_complete":true}').otherwise("{}")
    return table(spark, sf_dir, "orders").select("o_orderkey", streaks.no_backward_step(at(k), at(F.col("o_custkey")), rules.STAGES).alias("allowed"), rules.durable_month(state).alias("durable"))


@twin("SELECT * FROM (VALUES ('financial_report', 'year', 1, true), ('forum_post', 'day', 256, false), ('news_article', 'day', 256, true), ('holding_snapshot', 'day', 256, false)) v(dataset, granularity, buckets, relation_aware)")
def q_dataset_policies(spark, sf_dir):
    registry = SchemaRegistry()
    chosen = [registry.get(n)[0] for n in ("financial_report", "forum_post", "news_article", "holding_snapshot")]
    return spark.createDataFrame([(spec_of(s.name).name, s.granularity, s.buckets, s.relation_aware) for s in chosen if s is DATASETS[s.name]], "dataset string, granularity string, buckets int, relation_aware boolean")


@twin("SELECT * FROM (VALUES ('naver_finance', 'news_article'), ('naver_finance', 'forum_post'), ('hkexnews', 'attachment')) v(site_id, dataset)")
def q_chosen_datasets(spark, sf_dir):
    asked = {"naver_finance": ["news_article ", "forum_post", "news_article"], "hkexnews": ["attachment", ""]}
    return spark.createDataFrame([(s, d) for s, names in asked.items() for d in plugins.chosen_datasets(plugins.site(s), names)], "site_id string, dataset string")


@twin("SELECT n_nationkey, 'https://finance.naver.com/research/' || ['market_info', 'invest', 'company', 'industry', 'economy', 'debenture'][n_nationkey % 6 + 1] || '_list.naver?page=' || (n_nationkey + 1) AS url FROM nation")
def q_research_urls(spark, sf_dir):
    names = sites.research_categories(["Market", "all", "company"])
    category = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("n_nationkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "nation").select("n_nationkey", sites.research_list_url(category, F.col("n_nationkey") + 1).alias("url"))


@twin("SELECT s_suppkey, s_suppkey % 6 <> 0 AND s_suppkey % 5 <> 1 AND s_suppkey % 7 <> 3 AS allowed, CASE WHEN s_suppkey % 6 = 0 THEN 'instruments must be 1 or more' WHEN s_suppkey % 5 = 1 THEN 'a large run needs confirmation' WHEN s_suppkey % 7 = 3 THEN 'recovery is still pending' ELSE '' END AS reason FROM supplier")
def q_run_plans(spark, sf_dir):
    k = F.col("s_suppkey")
    g = rules.run_plan_guard(instruments=F.when(k % 6 == 0, 0).when(k % 5 == 1, 500).otherwise(20), confirmed=k % 5 != 1, pending=F.when(k % 7 == 3, 1).otherwise(0))
    return table(spark, sf_dir, "supplier").select("s_suppkey", g["allowed"].alias("allowed"), g["reason"].alias("reason"))


@twin("SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, CAST(0 AS BIGINT) AS missing, props AS compact FROM events".replace("props AS compact", "replace(props, ' ', '') AS compact"))
def q_runtime_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", rules.counter_of(F.col("props"), "$.runtime.k", "$.k").alias("k"), rules.counter_of(F.col("props"), "$.nothing").alias("missing"), text.compact_json(F.col("props")).alias("compact"))


@twin("SELECT o_orderkey, o_orderkey % 3 = 0 AND o_custkey % 2 = 0 AND o_orderkey % 5 > 0 AS durable, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus ELSE '' END AS sort_text FROM orders")
def q_durable_requests(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    state = F.concat(F.lit('{"scope_complete":'), F.when(k % 3 == 0, "true").otherwise("false"), F.lit(',"request_signature":"'), F.when(c % 2 == 0, "a").otherwise("b"), F.lit('"}'))
    durable = rules.durable_request(state, F.when(k % 5 > 0, "full").otherwise("incremental"), F.lit("a"))
    return table(spark, sf_dir, "orders").select("o_orderkey", durable.alias("durable"), text.sort_text(F.when(k % 5 > 0, F.col("o_orderstatus"))).alias("sort_text"))
