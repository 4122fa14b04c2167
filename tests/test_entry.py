"""The driver's contract."""

import importlib

import __spark_entry__ as entry
import pytest
from lakeloom.queries_sql import SQL


def test_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["record_uid", "instrument_id", "event_time", "title"]


def test_rest_needs_no_llm(monkeypatch):
    import builtins

    real = builtins.__import__

    def without(name, globals=None, locals=None, fromlist=(), level=0):
        if name.startswith(("lakeloom.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", without)
    fresh = importlib.reload(entry)
    assert fresh.queries() and not any(n.startswith("op") for n in fresh.queries())
    monkeypatch.undo()
    importlib.reload(entry)


@pytest.mark.parametrize("name", ["q_relation_filter", "q_cdc_state_after", "q_latest_version", "q_interval_overlap", "q_audit_issues"])
def test_twins_agree(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("events", "orders", "customer", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = entry.queries()[name](spark, folder)
    made = con.execute(SQL[name])
    columns = [d[0] for d in made.description]
    want = made.fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, want))
