"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: cores. It also reports what the record lake saves: files that a pruned
query touches against all, a scan of small files against the compacted ones, and the number of catalog lookups for 1,
100 and 1000 instruments. The lake of all events is written once, apart from the queries on it (lake.write_sec).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeloom import queries
from lakeloom.model import DATASETS
from lakeloom.plans import query
from lakeloom.sources import catalog, lake

SF, CPUS = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "q_canonical_projection", "q_version_hash", "q_partition_layout", "q_filter_instrument_date_tz", "q_multi_instrument", "q_relation_filter", "q_relation_bridge", "q_pruned_equals_full",
    "q_topn_ordered", "q_cdc_classify", "q_cdc_state_after", "q_compaction_plan", "q_latest_version", "q_contiguous_watermark", "q_stop_rule_streak", "q_interval_overlap", "q_audit_issues",
    "q_completeness", "q_progress_rollup", "q_retention", "q_resume_classify", "q_set_reconcile", "q_clean_text", "q_relative_time", "q_url_ids", "q_html_links", "q_html_article", "q_bridge_join", "q_stream_dedup",
]


def seconds(f) -> float:
    began = time.time()
    f()
    return round(time.time() - began, 3)


def lake_figures(spark: SparkSession) -> dict:
    small, spec = queries.event_lake(spark, SF), DATASETS["forum_post"]
    compact = f"{small}-compact"
    all_ = lake.read_lake(spark, small)
    all_.repartition(1).write.parquet(compact)
    asked = query.QuerySpec("events", "forum_post", instrument_ids=["XUSR:000008"], start_date="2024-01-05", end_date="2024-01-07", timezone="Asia/Seoul")
    pruned = query.on_lake(all_, asked)
    # Sums of whole files aren't what is timed here, so the catalog goes without them.
    files = catalog.upserted(catalog.empty(spark), lake.files_of(spark.read.parquet(small), spec).withColumn("sha256", F.lit("")))
    files = catalog.mark_uploaded(files, files.select("file_path", F.col("file_path").alias("remote_path"))).cache()
    lookups, took = {}, {}
    for n in (1, 100, 1000):
        stats = query.QueryStats()
        took[n] = seconds(lambda n=n, stats=stats: query.on_catalog(spark, files, query.QuerySpec("events", "forum_post", instrument_ids=[f"XUSR:{i:06d}" for i in range(n)], start_date="2024-01-05", end_date="2024-01-05"), stats).collect())
        lookups[n] = stats.catalog_lookups
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    return {
        "files_all": files.count(), "files_pruned": query.candidates(files, query.normalised(asked)).count(), "scan_small_sec": seconds(lambda: noop(all_)), "scan_compacted_sec": seconds(lambda: noop(spark.read.parquet(compact))),
        "pruned_query_sec": seconds(pruned.collect), "catalog_lookups": lookups, "catalog_query_sec": took,
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lakeloom-bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF}/orders.parquet").count()
    wrote, took = seconds(lambda: queries.event_lake(spark, SF)), {}
    for name in HEADLINE:
        run = lambda: queries.QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()  # noqa: E731, B023
        took[name] = seconds(run)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF), "lake": {"write_sec": wrote} | lake_figures(spark)}))


if __name__ == "__main__":
    main()
