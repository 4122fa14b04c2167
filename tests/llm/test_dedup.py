"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from lakeloom.llm import near_dedup, substring_dedup, suffix_sort
from lakeloom.llm.components import connected
from lakeloom.llm.exact_dedup import drop_exact_copies, exact_dedup
from lakeloom.llm.near_dedup import drop_near_copies, near_duplicates
from lakeloom.llm.shingles import WordHashes, corrected, shingle_set, signature
from lakeloom.llm.substring_dedup import remove_repeats

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns that no operator reads, under names that operators use themselves.
CLASH = "_id string, _hash string, _digest string, _n string, _row string, kept string, _text string"


def frame(spark, rows, clash=True):
    schema = "doc_id long, text string" + (", " + CLASH if clash else "")
    return spark.createDataFrame([(*r, *("z",) * 7) if clash else r for r in rows], schema)


def test_exact(spark):
    rows = [(1, "A b"), (2, "a B"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 300_000), (8, "X" * 300_000), (9, "a b"), (9, "a b"), (None, "a b"), (10, "k")]
    rows += [(100 + i, "hot TEXT" if i % 2 else "Hot text") for i in range(300)]
    got = exact_dedup(frame(spark, rows), runs=8, fan_in=2).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    want = Counter()
    for i, t in rows:
        g = groups[(t or "").translate(LOWER)]
        keep = max(x for x in g if x is not None)
        want[(i, keep, len(g), hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sorted(r.doc_id for r in got if r.kept) == sorted(max(x for x in g if x is not None) for g in groups.values())


def test_exact_drop_and_empty(spark):
    kept = drop_exact_copies(frame(spark, [(1, "a"), (2, "A"), (3, None), (4, ""), (5, "b"), (5, "b")]))
    rows = kept.collect()
    assert {r.doc_id for r in rows} == {2, 4, 5} and kept.columns == ["doc_id", "text", *CLASH.replace(" string", "").split(", ")]
    assert all(r["_digest"] == "z" for r in rows)
    assert exact_dedup(frame(spark, [])).count() == 0 and drop_exact_copies(frame(spark, [])).count() == 0


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k, percent):
    sets, parent = [shingles(t, k) for _, t in rows], list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[top(b)] = top(a)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[top(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(least[top(i)])) for i in range(len(rows))]


def near_rows():
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    rows = [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "a b"), (6, " \t"), (7, "a b c d"), (8, "long " * 30_000 + "end")]
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            w[rng.randrange(90)] = f"x{rng.randrange(9999)}"
        rows.append((100 + i, " ".join(w)))
    return rows + [(300 + i, " ".join(base)) for i in range(40)]


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near(spark, monkeypatch, k, percent):
    monkeypatch.setattr(near_dedup, "BLOCK", 32)
    monkeypatch.setattr(near_dedup, "HUB_PAIRS", 16)
    rows = near_rows()
    got = near_duplicates(frame(spark, rows), width=k, percent=percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(brute_components(rows, k, percent))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_drop_and_empty(spark):
    rows = near_rows()[:60]
    rows += [rows[-1], (8, rows[-1][1] + " q")]  # a repeated row, and an id that comes twice
    kept = drop_near_copies(frame(spark, rows)).collect()
    classes = {c for _, _, c in brute_components(rows, 5, 80)}
    assert {r.doc_id for r in kept} == classes
    assert all(r["_hash"] == "z" for r in kept)
    assert near_duplicates(frame(spark, [])).count() == 0


def test_estimate_is_close():
    a = np.arange(4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    b = np.concatenate([a[:3500], a[:500] ^ np.uint64(1 << 40)])
    agree = np.array([(signature(a) == signature(b)).sum()])
    assert abs(corrected(agree, np.array([4000.0]), np.array([4000.0]))[0] - 3500 / 4500) < 0.15
    assert len(shingle_set("a b c", 3, WordHashes())) == 1


def test_components_of_a_chain(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102), (102, 101), (200, 200)]
    rng.shuffle(edges)
    got = dict(connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100, 103: 100}
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_repeats(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s : s + length] for _, b in data for s in range(len(b) - length + 1))
    out = Counter()
    for i, b in data:
        mark = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                mark[s : s + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out[(i, len(b), sum(mark), len(re.findall(rb"\x01+", bytes(mark))), hashlib.sha256(kept).hexdigest())] += 1
    return out


def repeat_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(60))
    rows = [(1, None), (2, ""), (3, "a" * 900), (4, "ab" * 99), (5, "é" * 150 + passage[:260]), (6, passage), (7, passage[40:]), (8, "row " * 90), (8, "row " * 90), (9, "é" * 99)]
    for i in range(60):
        rows.append((20 + i, " ".join(word() for _ in range(rng.randrange(1, 60))) + " " + passage[rng.randrange(60) : 200 + rng.randrange(120)] + " " + " ".join(word() for _ in range(30))))
    return rows


@pytest.mark.parametrize(("hot", "pairs"), [(65_536, 160), (65_536, 2), (8, 160)])
def test_repeats(spark, monkeypatch, hot, pairs):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "PAIRS", pairs)
    rows = repeat_rows()
    assert Counter(map(tuple, remove_repeats(frame(spark, rows)).collect())) == brute_repeats(rows, 200)


def test_repeats_empty(spark):
    assert remove_repeats(frame(spark, [])).count() == 0


def test_repeats_at_the_ends_of_texts(spark):
    """Texts that lie side by side in a batch: what goes on from one into the next is no string of either."""
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    passage = noise(330)
    texts = [noise(90) + "=" * 450, "=" * 450 + noise(60), noise(50) + "-" * 199, "-" * 199 + noise(50), passage[:170] + noise(120), noise(120) + passage[:260], passage[60:], "+*" * 300, "+*" * 300, noise(99), None, "*" * 199]
    rows = list(enumerate(texts)) + [(50, noise(70) + passage[:199]), (51, passage[199:] + noise(150))]
    got = remove_repeats(frame(spark, rows).coalesce(1)).collect()
    assert Counter(map(tuple, got)) == brute_repeats(rows, 200)


def test_texts_of_a_batch_are_worked_on_together(monkeypatch):
    """Many short texts cost NumPy calls by their bytes, not by their number, and have the anchors that each has alone."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcd") for _ in range(rng.randrange(500))) for _ in range(200)] + ["x" * 900, "x" * 700, "", "ab" * 450, "z" * 200]
    alone = [(i, p) for i, t in enumerate(texts) for p in suffix_sort.anchors(t.encode(), 200).tolist()]
    calls, real = [], suffix_sort.segment_anchors
    monkeypatch.setattr(suffix_sort, "segment_anchors", lambda *a: calls.append(1) or real(*a))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["_ref", "_text"])
    for segment in (1 << 20, 777):
        monkeypatch.setattr(suffix_sort, "SEGMENT", segment)
        got = [(r["_ref"], r["_pos"]) for b in substring_dedup.anchored(iter([batch]), 200) for r in b.to_pylist()]
        assert got == alone
        if segment > 777:
            assert len(calls) == 1


def test_deep_shallow():
    rng = random.Random(2)
    texts = [("p" * 70 + "".join(rng.choice("ab") for _ in range(rng.randrange(40)))).encode() for _ in range(200)] + [b"", b"a", b"p" * 70, b"a"]
    width = max(map(len, texts))
    rows = np.zeros((len(texts), width), np.uint8)
    for i, t in enumerate(texts):
        rows[i, : len(t)] = np.frombuffer(t, np.uint8)
    order = suffix_sort.deep_shallow(rows, np.array([len(t) for t in texts]))
    assert [texts[i] for i in order] == sorted(texts)


def test_anchors_are_shared():
    rng = random.Random(4)
    core = bytes(rng.randrange(97, 101) for _ in range(200))
    a = bytes(rng.randrange(97, 101) for _ in range(333)) + core + b"zz"
    b = b"q" * 77 + core + bytes(rng.randrange(97, 101) for _ in range(500))
    places = lambda d: {p - d.index(core) for p in suffix_sort.anchors(d, 200).tolist() if 0 <= p - d.index(core) <= 200 - suffix_sort.KEY}
    assert places(a) & places(b)
