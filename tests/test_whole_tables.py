"""Queries read whole texts and whole tables."""

import __spark_entry__ as entry
import duckdb
from lakeloom import queries
from lakeloom.functions import extract


def parts_by_both(spark, tmp_path, name, *keys):
    """Rows of a query over parts with these keys, and of its SQL."""
    rows = [(k, f"name {k}", f"Brand#{k % 7}", "LARGE", k % 50 + 1, 1.0) for k in keys]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    made = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in made.description]
    got = entry.queries()[name](spark, str(tmp_path))
    return sorted(tuple(r[c] for c in columns) for r in got.collect()), sorted(made.fetchall())


def test_texts_are_read_to_their_ends(spark, tmp_path):
    long = "word " * 100 + "\n\n  last  line 42 end"
    spark.createDataFrame([(1, long), (2, "none"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    clean = {r.doc_id: r for r in queries.q_clean_text(spark, str(tmp_path)).collect()}
    assert clean[1].lines == ("word " * 100).strip() + "\nlast line 42 end"
    assert clean[1].plain.startswith("word word") and clean[1].plain.endswith("last  line 42 end\nx & y\nz")
    assert clean[1].line == "<b>" + "word " * 100 + "last line 42 end</b> <br/> x & y z"
    assert clean[1].stripped == f"<b>{long}</b> <br/>  x &amp; y\n\n\n\n z"
    assert {r.doc_id: r.b for r in queries.q_parse_int(spark, str(tmp_path)).collect()} == {1: 42, 2: None, 3: None}


def test_deltas_of_all_keys(spark, tmp_path):
    spark.createDataFrame([(i, i % 3 * 40) for i in range(9)], "event_id long, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.delta for r in queries.q_counter_delta(spark, str(tmp_path)).collect()}
    assert got == {i: i * 3 if i < 3 else 9 for i in range(9)}


def test_rows_of_whole_pages(spark, tmp_path):
    page = "<p>" + "text " * 100 + "</p><table><tr><td>own</td><td>row</td></tr></table>"
    spark.createDataFrame([(1, page), (2, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, queries.q_html_rows(spark, str(tmp_path)).collect()))
    assert got == [(1, 0, "own|row"), (1, 1, "id|1"), (1, 2, "a b"), (2, 0, "id|2"), (2, 1, "a b")]


def test_entities_that_were_cut(spark, tmp_path):
    bodies = ["&amp;&amp;&amp", "a &lt b &am", "&lt;b&gt; &quot;x&quot; R&D &unknown; &ampere; &amp;lt;", "<a href='?a=1&amp=2&copy=3'>l</a> &nbsp x"]
    pages = [(i, f"<html><body><article><p>{'text ' * 30}{b}</p></article></body></html>") for i, b in enumerate(bodies)]
    spark.createDataFrame([*pages, (9, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = sorted(map(tuple, queries.q_html_article(spark, str(tmp_path)).collect()))
    assert got == sorted(con.execute(entry.oracle_sql()["q_html_article"]).fetchall())
    assert extract.article_text(f"<body>{bodies[0]}</body>", ("body",), 1) == "&&&"
    assert extract.article_text(f"<body>{bodies[0]} &eacute; &#8217; &#x41; &#39</body>", ("body",), 1, strict=True) == "&&&amp é ’ A &#39"


def test_codes_of_long_keys(spark, tmp_path):
    got, want = parts_by_both(spark, tmp_path, "q_hkex_codes", 0, 16, 80016, 99999, 100000, 119999, 1000001)
    assert got == want and (100000, "10000,00080", "XHKG:00000") in got


def test_results_of_long_keys(spark, tmp_path):
    got, want = parts_by_both(spark, tmp_path, "q_hkex_results", 0, 16, 99999, 100000, 119999, 1000001)
    assert got == want and {r[0]: r[2] for r in got}[119999] == "11999"


def test_listings_of_long_keys(spark, tmp_path):
    got, want = parts_by_both(spark, tmp_path, "q_market_sum", 0, 1, 99999, 100000, 100001, 999999, 1000000, 1000001, 1000019)
    assert got == want and [r[1] for r in got if r[0] == "100000"] == ["name 100000", "name 1000000", "name 1000001"]
