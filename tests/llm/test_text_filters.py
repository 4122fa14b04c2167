"""Decontamination, personal data, licences, toxicity, languages, urls, mixing."""

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from lakeloom.llm import decontaminate as decon
from lakeloom.llm import mixing
from lakeloom.llm.boosting import fit_trees, total
from lakeloom.llm.decontaminate import decontaminate, drop_contaminated
from lakeloom.llm.language import identify
from lakeloom.llm.license_templates import TEMPLATES
from lakeloom.llm.licenses import scan_licenses
from lakeloom.llm.mixing import exact_weights, mix, one_period, phases, whole_weights
from lakeloom.llm.pii import find_pii
from lakeloom.llm.toxicity import drop_toxic, fit_toxicity, grade_documents
from lakeloom.llm.url_filter import RULES, Segmenter, filter_urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "_id string, _hash string, _row string, _h string, _lane string, rejected string, n_hit string"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame([(*r, *("z",) * 7) for r in rows], f"{schema}, {CLASH}")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute_hits(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[s : s + width]), set()).add(str(i))
    out = Counter()
    for i, t in docs:
        w, hit, own = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if tuple(w[s : s + k]) in windows:
                    hit |= set(range(s, s + k))
                    own |= windows[tuple(w[s : s + k])]
        out[(i, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit))] += 1
    return out


def decon_rows():
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice("abcdefg") * rng.randrange(1, 3) for _ in range(n))
    items = [(1, say(25)), (2, say(12)), (10, "Short item"), (11, "é"), (12, None), (13, "..."), (1, say(10)), (14, say(25))]
    docs = [(0, None), (1, ""), (2, "..."), (3, "SHORT, item"), (4, "é short é item"), (5, "x " * 40_000 + (items[0][1] or "")), (6, items[1][1]), (6, items[1][1]), (6, "else"), (None, items[0][1])]
    for i in range(60):
        t = items[rng.choice([0, 1, 6, 7])][1].split()
        docs.append((20 + i, say(30) + " " + " ".join(t[rng.randrange(5) : len(t) - rng.randrange(4)]) + "! " + say(5)))
    return docs, items


@pytest.mark.parametrize("block", [100_000, 10])
def test_decontaminate(spark, block):
    docs, items = decon_rows()
    benchmark = frame(spark, items, "item_id long, text string")
    got = Counter(map(tuple, decontaminate(frame(spark, docs), benchmark, block=block).collect()))
    assert got == brute_hits(docs, items)


def test_decontaminate_edges(spark):
    docs, items = decon_rows()
    benchmark = frame(spark, items, "item_id long, text string")
    kept = drop_contaminated(frame(spark, docs), benchmark).collect()
    clean = Counter(k[0] for k, n in brute_hits(docs, items).items() if not k[-1] for _ in range(n))
    assert Counter(r.doc_id for r in kept) == clean and all(r["_hash"] == "z" for r in kept)
    assert decontaminate(frame(spark, []), benchmark).count() == 0
    none = decontaminate(frame(spark, docs), frame(spark, [], "item_id long, text string")).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    assert decon.BETWEEN_WORDS


BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    ok = [
        lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")),
        lambda s: 13 <= len(d := re.sub(r"\D", "", s)) <= 19 and luhn(d), lambda s: 9 <= len(re.sub(r"\D", "", s)) <= 15,
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, f in zip(("email", "ip", "card", "phone"), BASE, ok, strict=True) for m in re.finditer(p, text or "", re.A) if f(m.group())]


def test_pii(spark):
    texts = [
        None, "", "é a@b.c_d@e.f x@y foo@bar@c.d. \U0001f600 q.r+s@t-u.v.w..", "1.2.3.4.5.6.7.8 300.1.1.1 000255.1.1.1 99999999999999999999.1.2.3 v1.2.3.4",
        "+4a +49 (170) 12-34.567 +1 2 4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "1" * 50_000 + "@x.y", "a" * 50_000, "Call +1 (599) 555-0271 or mail x.01@mail8.example.com, ip 3.76.85.226!", "a@b.cc " * 3000,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, "other 1.1.1.1")]
    got = find_pii(frame(spark, rows)).collect()
    want = Counter()
    for i, t in rows:
        spans = brute_pii(t)
        n = Counter(s.split(":")[0] for s in spans)
        want[(i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    for r in got:
        spans = r.spans.split(",") if r.spans else []
        base = [s for t in (t for i, t in rows if i == r.doc_id) for s in brute_pii(t)]
        assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added and len(set(spans) & set(base)) >= len(spans) - r.n_added
    assert find_pii(frame(spark, [])).count() == 0


def test_boosting_separates():
    x = np.array([[a, b] for a in range(6) for b in range(4)])
    n, y = np.full(len(x), 50.0), np.where((x[:, 0] > 2) & (x[:, 1] > 1), 45.0, 5.0)
    base, trees = fit_trees(x, n, y)
    assert all((total(base, trees, r) > 0) == (v > 25) for r, v in zip(x, y, strict=True))


def test_licenses(spark):
    notices = {k: v[0] for k, v in TEMPLATES.items()}
    rows = [(i, f"Some text before.\n{v}\nmore") for i, v in enumerate(notices.values())]
    rows += [(50, None), (51, ""), (52, "the driving licence of my aunt"), (53, ("word " * 40_000) + "Released under the MIT License."), (54, notices["MIT"] + "\n\n" + notices["Apache-2.0"]), (55, "This work is licensed under the GNU General Public License, version 9.")]
    got = {r.doc_id: r for r in scan_licenses(frame(spark, rows)).collect()}
    assert [got[i].licenses for i in range(len(notices))] == [[k] for k in notices]
    assert [got[i].licenses for i in (50, 51, 52, 53, 54, 55)] == [[], [], [], ["MIT"], ["Apache-2.0", "MIT"], []]
    spot = got[54].spans[0]
    assert rows[-2][1][spot.start : spot.end].startswith("Released under")
    assert scan_licenses(frame(spark, [])).count() == 0


PROSE = "Morning light fell on the harbour while nine boats left for colder waters and somebody counted crates by hand. "


def test_licenses_in_prose(spark):
    notices = {k: v for k, v in TEMPLATES.items()}
    cases = [(k, before + t + after) for k, v in notices.items() for t in v for before, after in [("", " " + PROSE * 9), (PROSE * 4, " " + PROSE * 4), (PROSE * 9, "")]]
    got = {r.doc_id: r for r in scan_licenses(frame(spark, [(i, t) for i, (_, t) in enumerate(cases)])).collect()}
    assert [(i, k) for i, (k, _) in enumerate(cases) if k not in got[i].licenses] == []
    all_ = "".join(f"{v[0]} {PROSE}" for v in notices.values())
    assert scan_licenses(frame(spark, [(1, all_)])).first().licenses == sorted(notices)
    twice = f"{notices['MIT'][0]} {PROSE} {notices['MIT'][0]}"
    assert len(scan_licenses(frame(spark, [(1, twice)])).first().spans) == 2


def test_licenses_across_lines(spark):
    wrapped = lambda t: "\n".join(f"# {x}" for x in textwrap.wrap(t, 72))
    cases = [(k, f"{PROSE}\n{wrapped(t)}\n\n{PROSE}") for k, v in TEMPLATES.items() for t in v]
    owners = "\n".join(f"Copyright (c) 20{i:02d} the holders of part {i}" for i in range(40))
    cases += [("MIT", f"{owners}\n{wrapped(TEMPLATES['MIT'][1])}"), ("BSD-3-Clause", TEMPLATES["BSD-3-Clause"][0].replace("are met: ", "are met:\n\n1. "))]
    cases += [("CC0-1.0", "Released under\nCC0\n1.0."), ("ISC", wrapped(TEMPLATES["ISC"][0].replace("copyright", "ownership")).replace(" all ", " all\n").replace("hereby ", "hereby\n"))]
    got = {r.doc_id: r for r in scan_licenses(frame(spark, [(i, t) for i, (_, t) in enumerate(cases)])).collect()}
    assert [(i, k) for i, (k, _) in enumerate(cases) if k not in got[i].licenses] == []


def toxic_rows():
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(600):
        w = [rng.choice(["haus", "baum", "wald", "garten", "blume", "wasser", "stein"]) + rng.choice(["", "lein", "chen"]) for _ in range(rng.randrange(5, 80))]
        bad = i % 4 == 0
        for _ in range(rng.randrange(2, 6) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["nastyword", "vilething", "nastyfolk"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = toxic_rows()
    lab = spark.createDataFrame([*labels[:400], (None, 1), (3, None)], "doc_id long, toxic int")
    rows = [*docs, (1000, None), (1001, ""), (1002, "x " * 50_000), (1003, "haus baum " * 20 + "nastyword vilething nastyfolk vilething")]
    got = {r.doc_id: r for r in grade_documents(frame(spark, rows), lab).collect()}
    wrong = [i for i, y in labels[400:] if got[i].rejected != bool(y)]
    assert len(wrong) <= 4
    assert all(0 <= r.severity <= 2 and r.rejected == (r.grade > 0) for r in got.values())
    assert not any(got[i].rejected for i in (1000, 1001, 1002)) and got[1003].rejected
    kept = drop_toxic(frame(spark, rows), lab).collect()
    assert {r.doc_id for r in kept} == {i for i, r in got.items() if not r.rejected} and all(r.rejected == "z" for r in kept)
    assert drop_toxic(frame(spark, []), lab).count() == 0
    model = fit_toxicity(frame(spark, docs), lab.where("toxic = 0"))
    assert not model.score(pd.Series(["nastyword vilething"])).rejected[0]
    assert model.thresholds[0] <= model.thresholds[1]


def test_language(spark):
    rng = random.Random(3)
    sound = {"aa": ["ta", "ka", "ma", "ra"], "oo": ["lo", "so", "no", "po"], "éé": ["dé", "vé", "bé", "gé"]}
    rows = [(i, " ".join("".join(rng.choice(sound[k]) for _ in range(3)) for _ in range(25)), k) for i in range(300) for k in [rng.choice(list(sound))]]
    more = [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !!", None), (903, "takama" * 100_000, None), (None, "tama kara", None), (5, "ta", None)]
    docs = frame(spark, rows + more, "doc_id long, text string, lang string")
    got = identify(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows + more)
    by = {r.doc_id: r for r in got if r.doc_id != 5}
    held = [r for r in rows if by.get(r[0]) and by[r[0]].held_out]
    assert sum(by[i].lang_pred == k for i, _, k in held) / len(held) > 0.95
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902)) and by[903].lang_pred == "aa"
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in by if i is not None)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in identify(docs.where("lang is null")).collect()} == {"und"}


def test_urls(spark):
    page = "<p>green garden house blog news sport</p>"
    urls = [
        "http://a.com/x", "https://WWW.Example.com/en/1", "https://m.example.com/en/?q", "http://x.net/es/1", "http://net/fr/", "ftp://é.org#f", "no scheme", None, "http://a.com?x://b.net/fr/", "http://notexample.com/en/",
        "http://greengarden.org/news", "http://x.com", "http://example.com/de/",
    ]
    rows = [(i, u, page) for i, u in enumerate(urls)]
    got = {r.page_id: r for r in filter_urls(frame(spark, rows, "page_id long, url string, html string")).collect()}

    def want(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.translate(LOWER)
        fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fit)[1:] if fit else (None, None))

    for i, u in enumerate(urls):
        host, path, rule, verdict = want(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
    assert got[10].host_words == "green garden"
    assert filter_urls(frame(spark, [], "page_id long, url string, html string")).count() == 0
    assert Segmenter({}).words("abc") == ["abc"]


def test_period_is_fair():
    weights = whole_weights({"a": 0.61, "b": 0.3, "c": 0.09}, 100)
    slots = one_period(weights)
    total_ = sum(weights.values())
    assert sorted(s for v in slots.values() for s in v) == list(range(total_))
    for k, q in weights.items():
        for t in range(total_ + 1):
            assert abs(Fraction(q * t, total_) - sum(s < t for s in slots[k])) < 1


def test_mix(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else "small") for i in range(900)] + [(2000 + i, None, None) for i in range(20)] + [(5000, "", "one"), (5000, "", "one")]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    weights = {"big": 0.5, "small": 0.3, "one": 0.1}
    got = mix(docs, weights, block_docs=4).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows) and len({r.mix_order for r in got}) == len(rows)
    assert all(r["_h"] == "z" for r in got)
    share = whole_weights({"=big": 0.5, "=small": 0.3, "null": 0.1, "=one": 0.1}, 1000)
    slots = {r.mix_slot: (r.mix_phase, r.mix_lane) for r in got}
    assert sorted(slots) == list(range(len(slots)))
    for phase in {p for p, _ in slots.values()}:
        own = [lane for s, (p, lane) in sorted(slots.items()) if p == phase]
        live = {r.mix_lane for r in got if r.mix_phase >= phase}
        for lane in live:
            for t in range(len(own) + 1):
                assert abs(Fraction(share[lane] * t, sum(share[x] for x in live)) - own[:t].count(lane)) < 1
    assert mix(docs.where("false")).count() == 0
    assert mix(docs).count() == len(rows)


def test_schedule_does_not_drift():
    weights = exact_weights({"a": 0.99951, "b": 0.00049})
    assert weights == {"a": 99951, "b": 49}
    n, total_ = Counter(), sum(weights.values())
    for k, _, j, slot in phases({"a": 40_000, "b": 40}, weights):
        if slot == 30_000:
            break
        assert j == n[k]
        n[k] += 1
        assert all(abs(Fraction(q * (slot + 1), total_) - n[x]) < 1 for x, q in weights.items())


def test_mix_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_LANES", 2)
    monkeypatch.setattr(mixing, "BATCH", 50)
    sizes = {"p": 400, "q": 300, "r": 240, "s": 120, None: 60}
    rows = [(i, "t", s) for s, n in sizes.items() for i in range(n)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), {"p": 0.2, "q": 0.2, "r": 0.1, "s": 0.4, None: 0.1}, block_docs=4).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows) and len({r.mix_order for r in got}) == len(rows)
    first = [r for r in sorted(got, key=lambda r: r.mix_order) if r.mix_phase == 0]
    rest = [r.source for r in first if r.mix_lane == "*"]
    assert abs(len(rest) / len(first) - 0.6) < 0.02
    # All of s is played by then; while it lasts it has four rows for each row of r and of null.
    played = rest[:150]
    assert abs(played.count("s") - 100) <= 2 and abs(played.count("r") - 25) <= 2


def test_mix_moves_whole_rows(spark):
    from lakeloom.llm.queries import op10_mix

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = op10_mix(spark, "/root/testdata/sf0.001").select(docs.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, docs.collect()))
