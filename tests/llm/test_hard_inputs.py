"""Long, monotonous, tied, repeated and clashing inputs, and results that mustn't depend on where work is cut."""

import hashlib
import random
import tracemalloc
from collections import Counter

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from lakeloom.llm import common, language, near_dedup, substring_dedup, suffix_sort, url_filter
from lakeloom.llm.exact_dedup import drop_exact_copies, exact_dedup
from lakeloom.llm.language import identify
from lakeloom.llm.licenses import scan_licenses
from lakeloom.llm.mixing import mix
from lakeloom.llm.near_dedup import drop_near_copies, near_duplicates
from lakeloom.llm.substring_dedup import remove_repeats
from lakeloom.llm.url_filter import filter_urls

from test_dedup import brute_components, brute_repeats


def docs_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("hot", [65_536, 4])
def test_runs_of_short_periods(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "BATCH", 4000)
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    rows = [
        (1, some(90) + " " * 1300 + some(80)), (2, " " * 230 + "x"), (3, some(30) + " " * 201), (4, " " * 200), (5, " " * 199), (6, some(300) + "ab" * 260 + some(20)), (7, "ba" * 101),
        (8, some(9) + "0123456789abcdef" * 40 + some(9)), (9, "0123456789abcdef" * 13), (10, some(50) + "0123456789abcdefg" * 40), (11, "0123456789abcdefg" * 12), (12, ("-" * 399 + "x") * 6), (13, "é" * 700), (14, "é" * 101),
    ]
    assert Counter(map(tuple, remove_repeats(docs_of(spark, rows)).collect())) == brute_repeats(rows, 200)


def test_megabytes_of_one_character(spark):
    rows = [(1, " " * 5_000_000), (2, "x" * 2_000_000 + "y"), (3, "a line\n" * 300_000), (4, "short")]
    got = {r.doc_id: r for r in remove_repeats(docs_of(spark, rows)).collect()}
    assert got[1].n_removed == 5_000_000 and got[1].n_spans == 1 and got[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[2].n_removed == 2_000_000 and got[2].kept_sha256 == hashlib.sha256(b"y").hexdigest()
    assert got[3].n_removed == 2_100_000 and got[4].n_removed == 0
    assert len(suffix_sort.anchors(b" " * 1_000_000, 200)) < 1000


def test_anchors_do_not_depend_on_segments(monkeypatch):
    rng = np.random.default_rng(1)
    data = bytes(rng.integers(97, 101, 20_000, dtype=np.uint8)) + b" " * 3000 + bytes(rng.integers(97, 101, 5000, dtype=np.uint8))
    whole = suffix_sort.anchors(data, 200)
    monkeypatch.setattr(suffix_sort, "SEGMENT", 777)
    assert suffix_sort.anchors(data, 200).tolist() == whole.tolist()


def test_texts_that_share_boilerplate(spark, monkeypatch):
    """Texts that agree in less than the threshold meet by signature only; near ones among them are all linked."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "WIDE", 2)
    rng = random.Random(6)
    common_ = [f"c{i}" for i in range(70)]
    rows = [(i, " ".join(common_ + [f"w{rng.randrange(10**6)}" for _ in range(40)])) for i in range(120)]
    rows += [(200 + i, t + " tail") for i, t in rows[::9]]
    got = near_duplicates(docs_of(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(brute_components(rows, 3, 85))


def test_what_travels_grows_with_the_texts(spark, monkeypatch):
    """The rows that meet by text are those with a partner, however many texts share the boilerplate."""
    written = []
    keep = near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", lambda df, name: (written.append((name, out := keep(df, name))), out)[1])
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(6)
    common_ = [f"c{i}" for i in range(60)]
    for n in (60, 240):
        rows = [(i, " ".join(common_ + [f"w{rng.randrange(10**6)}" for _ in range(60)])) for i in range(n)]
        near_duplicates(docs_of(spark, rows)).collect()
    assert [df.count() for name, df in written if name == "within"] == [0, 0]


@pytest.mark.parametrize("piece", [7, 50])
def test_pieces_of_a_text(monkeypatch, piece):
    rng, vectors = random.Random(1), language.Vectors()
    text = " ".join("".join(rng.choice("abcdé ßΣς1,") for _ in range(rng.randrange(1, 9))) for _ in range(400))
    whole = language.bundle(text, vectors)
    monkeypatch.setattr(language, "PIECE", piece)
    assert np.array_equal(language.bundle(text, vectors), whole)


def test_equal_cosines(spark):
    rows = [(i, "same words here", lang) for i in range(40) for lang in ("bb", "aa")]
    assert {r.lang_pred for r in identify(docs_of(spark, rows, "doc_id long, text string, lang string")).collect()} == {"aa"}


def test_tables_of_any_size(spark, monkeypatch):
    """Words and tokens that workers don't hold are joined, to the same result."""
    rng = random.Random(2)
    words = ["green", "garden", "blog", "news", "sport", "ocean", "river", "shop", "best", "deal"]
    name = lambda: "".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))
    top = ["com", "net", "org"]
    rows = [(i, f"http://{name()}.{rng.choice(top)}/{rng.choice(['en', 'es', 'fr', 'x'])}/{rng.choice(words)}-{rng.randrange(9)}", f"<p class=q>{' '.join(rng.choices(words, range(1, 11), k=20))}</p>") for i in range(200)]
    rows += [(500, "http://" + "green" * 40 + ".org/" + "a" * 50_000, "long " * 40_000), (501, None, None), (502, "http://x.org", ""), (502, "http://x.org", "")]
    pages = docs_of(spark, rows, "page_id long, url string, html string")
    want = sorted(map(tuple, filter_urls(pages).collect()), key=str)
    monkeypatch.setattr(url_filter, "LEXICON", 3)
    monkeypatch.setattr(url_filter, "TOKENS", 4)
    got = sorted(map(tuple, filter_urls(pages).collect()), key=str)
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert np.allclose([g[-1] for g in got], [w[-1] for w in want])


def test_hosts_of_many_strings():
    """A host has up to 63 strings a letter. They leave a worker in batches, and what is found comes back host by host."""
    rng = random.Random(5)
    label = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    hosts = [f"{label(60)}.{label(60)}.com" for _ in range(200)] + [label(10_000) + ".com", "x.com", ""]
    frame = pd.DataFrame({"_k": [str(i) for i in range(len(hosts))], "host": hosts})
    tracemalloc.start()
    sizes = [len(batch) for batch in url_filter.candidates(63)(iter([frame]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) > 1_200_000 and max(sizes) < 2 * url_filter.LOOKED_UP + 63 and peak < 20_000_000
    few = frame.iloc[[0, -3, -2, -1]]
    got = {tuple(r) for batch in url_filter.candidates(5)(iter([few])) for r in batch.itertuples(index=False)}
    assert got == {(k, label[a : a + n]) for k, host in zip(few["_k"], few["host"], strict=True) for label in host.split(".")[:-1] for n in range(2, 6) for a in range(len(label) - n + 1)}

    rows = [("a", "", "bad", 2), ("a", "badcab.com", "", 0), ("a", "", "cab", 3), ("b", "cab.com", "", 0), ("c", "", "", 0)]
    parts = [pd.DataFrame(rows[a:b], columns=["_k", "host", "w", "n"]) for a, b in ((0, 1), (1, 4), (4, 5))]
    words = pd.concat(url_filter.cut(url_filter.Segmenter({"d": 1}, 10))(iter(parts)))
    assert list(words.itertuples(index=False, name=None)) == [("badcab.com", ["bad", "cab"]), ("cab.com", ["cab"]), ("", [])]


def test_hosts_of_any_length(spark, monkeypatch):
    """Long hosts that begin alike keep their own words, with the lexicon held by workers and joined."""
    words = ["green", "garden", "blog", "news", "sport", "ocean", "river"]
    hosts = ["green" * 12 + end for end in ("abc", "abcd", "blog", "news", "newsblog", "blognews")] + ["garden" * 9 + "ocean" * n for n in (1, 2, 3, 2000)]
    rows = [(i, f"http://{h}.{top}/en/{i % 3}", f"<b>{' '.join(words[: 1 + i % 7])}</b>") for i, (h, top) in enumerate((h, top) for h in hosts for top in ("com", "net", "org"))]
    pages = docs_of(spark, rows, "page_id long, url string, html string")
    want = sorted(map(tuple, filter_urls(pages).collect()))
    assert len(want) == len(rows) and {w[5] for w in want} >= {"green " * 12 + "news blog", "green " * 12 + "blog news", "garden " * 9 + "ocean " * 1999 + "ocean"}
    monkeypatch.setattr(url_filter, "LEXICON", 2)
    got = sorted(map(tuple, filter_urls(pages).collect()))
    assert [g[:-1] for g in got] == [w[:-1] for w in want] and np.allclose([g[-1] for g in got], [w[-1] for w in want])


def test_mix_of_hard_rows(spark):
    long_ = "word " * 400_000
    rows = [(i, f"t{i}", "big", "in") for i in range(90)] + [(None, None, None, None)] * 7 + [(3, long_, "s", "in"), (3, "", "s", "x"), (3, "", "s", "y"), (3, "", "s", "y")]
    docs = docs_of(spark, rows, "doc_id long, text string, source string, mix_order string")
    got = mix(docs, block_docs=4)
    assert got.columns == ["doc_id", "text", "source", "mix_order_in", "mix_phase", "mix_slot", "mix_order", "mix_lane"]
    out = got.collect()
    assert Counter((r.doc_id, r.text, r.source, r.mix_order_in) for r in out) == Counter(rows) and len({r.mix_order for r in out}) == len(rows)


def test_stages_keep_clashing_columns(tmp_path, spark):
    """Through every stage: long, null, empty and repeated rows, and columns with names that operators use themselves."""
    rng = random.Random(4)
    say = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    rows = [(i, say(40), "en", "s", 1, "z", "z", "z", "z", "z") for i in range(30)] + [(40, say(300_000), "en", None, 1, *"zzzzz"), (41, None, None, None, None, *"zzzzz"), (None, say(30), None, "s", 1, *"zzzzz")]
    twice = (50, say(40), "en", "s", 1, *"zzzzz")
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, _id string, _hash string, _s string, mix_slot string"
    docs_of(spark, [*rows, twice, twice], schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs_of(spark, [(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs_of(spark, [(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(tuple(r)[:9] for r in got) == Counter(r[:9] for r in [*rows, twice])
    assert all(r["_row"] == r["_id"] == r["mix_slot_in"] == "z" for r in got)


def test_null_ids_tie(spark):
    rows = [(None, "a"), (None, "A"), (None, "b"), (2, "b"), (2, "b")]
    got = exact_dedup(docs_of(spark, rows), runs=4, fan_in=2).collect()
    assert Counter((r.keep_id, r.group_size) for r in got) == {(None, 2): 2, (2, 3): 3} and sum(r.kept for r in got) == 2
    assert len(drop_exact_copies(docs_of(spark, rows)).collect()) == 2
    assert len(drop_near_copies(docs_of(spark, [(None, "a b c"), (None, "a b c"), (None, None)])).collect()) == 2


def test_equal_reductions_and_long_text(spark):
    notice = "Released under the MIT License."
    rows = [(1, f"{notice} {notice}"), (2, "plain words " * 200_000 + notice), (3, f"{notice}\n\n{notice}"), (4, None), (5, "")]
    got = {r.doc_id: r for r in scan_licenses(docs_of(spark, rows)).collect()}
    assert got[1].licenses == got[2].licenses == got[3].licenses == ["MIT"] and len(got[1].spans) == 2
    assert got[2].spans[0].start == 2_400_000 and not got[4].licenses and not got[5].licenses


def test_shared_folder(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"

    class Session:
        conf = {}
        sparkContext = Cluster()

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Session())
    since = len(common.WRITTEN)
    kept, gone = common.stored(spark.range(3), "kept"), common.stored(spark.range(3), "gone")
    common.release(spark, since, keep=kept)
    assert kept.count() == 3 and len(common.WRITTEN) == since + 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        spark.read.parquet(gone.inputFiles()[0]).count()
