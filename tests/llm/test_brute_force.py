"""Operators that SQL can't express, against plain versions that share no code with them."""

import math
import random
import re
from collections import Counter
from itertools import product

import numpy as np
import zstandard
from lakeloom.llm import language, toxicity
from lakeloom.llm.language import identify
from lakeloom.llm.license_templates import TEMPLATES
from lakeloom.llm.licenses import blocks, scan_licenses
from lakeloom.llm.mixing import mix
from lakeloom.llm.pii import find_pii
from lakeloom.llm.toxicity import fit_toxicity, grade_documents
from lakeloom.llm.url_filter import filter_urls


def cuts(run):
    """Every way to cut a run into words."""
    for marks in product([False, True], repeat=max(0, len(run) - 1)):
        out, at = [], 0
        for i, m in enumerate(marks, 1):
            if m:
                out.append(run[at:i])
                at = i
        yield [*out, run[at:]]


def test_url_verdicts(spark):
    rng = random.Random(4)
    vocabulary = ["go", "gold", "old", "ol", "den", "dog", "art", "tar"]
    hosts = ["".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    rows = [(i, f"http://{h}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['es', 'en', 'fr', 'x7'])}/{rng.choice(vocabulary)}", "<b>" + " ".join(rng.choices(vocabulary, [8, 2, 5, 1, 4, 3, 2, 2], k=30)) + "</b>") for i, h in enumerate(hosts)]
    counts = Counter(w for _, _, html in rows for w in html[3:-4].split())
    total = sum(counts.values())
    cost = lambda words: sum(math.log(total / counts[w]) if w in counts else math.log(10 * total) + 2.3 * len(w) for w in words)

    def tokens(url):
        host, path = re.match(r"http://([^/]*)(.*)", url).groups()
        run = host.split(".")[0]
        words = min(cuts(run), key=lambda ws: (round(cost(ws), 9), [-len(w) for w in reversed(ws)]))
        return [f"h:{w}" for w in words], [f"p:{w}" if w.isalpha() else "p:#" for w in re.findall(r"[a-z]+|[0-9]+", path)]

    def rule(url):
        host, path = re.match(r"http://([^/]*)(.*)", url).groups()
        if host.endswith(".com"):
            return "allow"
        return "block" if host.endswith(".net") and path.startswith(("/es/", "/fr/")) else None

    seen, pages = {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, _ in rows:
        if label := rule(url):
            seen[label].update(sum(tokens(url), []))
            pages[label] += 1
    known = set(seen["allow"]) | set(seen["block"])
    size = {k: sum(c.values()) + len(known) + 1 for k, c in seen.items()}
    odds = lambda t: math.log((seen["allow"][t] + 1) / size["allow"]) - math.log((seen["block"][t] + 1) / size["block"]) if t in known else 0.0
    prior = math.log((pages["allow"] + 1) / (pages["block"] + 1))
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert any(rule(u) is None for _, u, _ in rows)
    for i, url, _ in rows:
        own, path = tokens(url)
        # Two cuts may cost the same; then the longest last words win in both.
        assert got[i].host_words == " ".join(w[2:] for w in own), url
        score = prior + sum(map(odds, own + path))
        assert math.isclose(got[i].score, score, abs_tol=1e-9)
        assert got[i].verdict == (rule(url) or ("allow" if score >= 0 else "block"))


def plain_words(text):
    return [m.lower().rstrip(".") for m in re.findall(r"[\w.-]+", text) if m.strip(".-")]


def differences(words, template):
    """The least number of insertions and deletions between two lists; a missing word with a digit isn't allowed."""
    row = [0]
    for t in template:
        row.append(row[-1] + 1 if not re.search(r"\d", t) else math.inf)
    for w in words:
        new = [row[0] + 1]
        for i, t in enumerate(template):
            new.append(min(row[i] if t == w else math.inf, row[i + 1] + 1, new[i] + 1 if not re.search(r"\d", t) else math.inf))
        row = new
    return row[-1]


def test_licenses(spark):
    rng = random.Random(2)
    short = {k: [t for t in all_ if len(t) < 120][:1] for k, all_ in TEMPLATES.items()}
    short = dict(list({k: v for k, v in short.items() if v}.items())[:6])
    say = lambda n: " ".join(rng.choice(["the", "license", "of", "copyright", "work", "all", "under", "plain", "words"]) for _ in range(n))
    rows = []
    for i in range(40):
        text = say(rng.randrange(1, 30))
        if i % 2:
            own = rng.choice(sorted(short))
            words = short[own][0].split()
            for _ in range(rng.randrange(3)):
                words.insert(rng.randrange(1, len(words)), "extra")
            text += "\n" + " ".join(words) + " " + say(rng.randrange(10))
        rows.append((i, text))
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates=short).collect()}
    raw = {k: zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(v[0].lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k, v in short.items()}
    for i, text in rows:
        words, found = plain_words(text), set()
        for k, (template,) in short.items():
            t = plain_words(template)
            most = int(0.1 * len(t))
            if any(differences(words[a:b], t) <= most for a in range(len(words)) for b in range(max(a + 1, a + len(t) - most), min(len(words), a + len(t) + most) + 1)):
                found.add(k)
        assert set(got[i].licenses) == found, text
        best = 0.0
        for _, block in blocks(text):
            data = " ".join(block.lower().split()).encode()
            alone = len(zstandard.ZstdCompressor(level=9).compress(data))
            best = max([best] + [1 - len(c.compress(data)) / alone for c in raw.values()])
        assert math.isclose(got[i].reduction, best, abs_tol=1e-9)


def test_toxicity_is_the_model(spark):
    """Features, probabilities and grades, from the fitted weights by the formula; and the fit beats weights nearby."""
    rng = random.Random(7)
    clean, bad = ["table", "window", "garden", "market", "river"], ["vilethings", "nastyword", "foulplay"]
    rows, labels = [], []
    for i in range(200):
        toxic = i % 4 == 0
        words = [rng.choice(clean) for _ in range(20)] + [rng.choice(bad) for _ in range(rng.randrange(1, 5) if toxic else 0)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, labelled = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit_toxicity(docs, labelled)
    got = {r.doc_id: r for r in grade_documents(docs, labelled).collect()}
    assert model.columns and model.thresholds[0] < model.thresholds[1]
    k = len(model.columns)
    for i, text in rows:
        words, c = text.split(), Counter()
        for w in words:
            c.update(f for f in toxicity.prefixes(w) if f in model.columns)
        x = np.zeros(2 * k + 2)
        if c:
            hits = max(sum(n for f, n in c.items() if f % 4 == size) for size in range(4))
            for f, n in c.items():
                x[model.columns[f]], x[k + model.columns[f]] = math.log1p(n), math.log1p(100 * n / len(words))
            x[2 * k], x[2 * k + 1] = math.log1p(hits), math.log1p(100 * hits / len(words))
            p = [1 / (1 + math.exp(t - float(model.weights @ x))) for t in model.thresholds]
        else:
            p = [0.0, 0.0]
        assert math.isclose(got[i].severity, sum(p), abs_tol=1e-6) and got[i].grade == sum(q >= 0.5 for q in p)
        assert got[i].rejected == (i % 4 == 0)


def test_language_is_the_nearest_prototype(spark):
    """Bundles from letter vectors, n-gram by n-gram; prototypes from the training rows; the largest cosine."""
    import zlib

    rng = random.Random(3)
    sound = {"aa": ["ta", "ka", "ma"], "oo": ["lo", "so", "no"], "uu": ["tu", "lu", "ka"]}
    rows = [(i, " ".join("".join(rng.choice(sound[k]) for _ in range(2)) for _ in range(6)), k) for i in range(90) for k in [rng.choice(sorted(sound))]]
    vectors = language.Vectors()

    def bundled(text):
        out, padded = np.zeros(language.DIMENSIONS), f" {text} "
        for a in range(len(padded) - 2):
            gram = np.ones(language.DIMENSIONS)
            for place, c in enumerate(padded[a : a + 3]):
                gram *= np.roll(vectors.letter(ord(c)), place)
            out += gram
        return out

    learned = {k: sum(bundled(t) / np.linalg.norm(bundled(t)) for i, t, lang in rows if lang == k and zlib.crc32(str(i).encode()) % 4 != 2) for k in sound}
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in rows:
        v = bundled(t)
        cosine = {k: float(p @ v / np.linalg.norm(p) / np.linalg.norm(v)) for k, p in learned.items()}
        best = max(cosine, key=lambda k: cosine[k])
        assert got[i].lang_pred == best and math.isclose(got[i].score, max(0.0, cosine[best]), abs_tol=1e-4)


def test_mix_is_the_schedule(spark):
    """Each slot by hand: of the released blocks the one that is due first."""
    from fractions import Fraction

    sizes = {"a": 50, "b": 23, "c": 9}
    weight = {"a": Fraction(5, 10), "b": Fraction(3, 10), "c": Fraction(2, 10)}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    got = mix(spark.createDataFrame(rows, "doc_id long, source string"), {k: float(w) for k, w in weight.items()}, block_docs=4).collect()
    left, slot, phase, want = {k: -(-n // 4) for k, n in sizes.items()}, 0, 0, []
    while left:
        total, done, at = sum(weight[k] for k in left), dict.fromkeys(left, 0), 0
        while True:
            ready = [k for k in left if math.floor(done[k] * total / weight[k]) <= at]
            k = min(ready, key=lambda k: (math.ceil((done[k] + 1) * total / weight[k]), k))
            want.append((slot, phase, k))
            done[k], left[k], at, slot = done[k] + 1, left[k] - 1, at + 1, slot + 1
            if not left[k]:
                del left[k]
                break
        phase += 1
    assert sorted({(r.mix_slot, r.mix_phase, r.source) for r in got}) == want
    # Within a source blocks are full but for the last one.
    for s, n in sizes.items():
        assert sorted(Counter(r.mix_slot for r in got if r.source == s).items()) == [(slot, min(4, n - 4 * j)) for j, slot in enumerate(x for x, _, k in want if k == s)]


def test_planted_personal_data(spark):
    """Of documents with planted data nine in ten and more are found by any kind, and clean ones are left alone."""
    rng = random.Random(5)
    say = lambda n: " ".join("".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    def card():
        d = [rng.randrange(10) for _ in range(15)]
        total = sum(x if i % 2 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d))
        return "".join(map(str, [*d, -total % 10]))

    make = [lambda: f"{say(1)}.{rng.randrange(99)}@mail.example.com", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), card, lambda: f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}", lambda: f'token = "{rng.getrandbits(160):040x}"']
    rows = [(i, f"{say(30)} {make[i % 5]()} {say(20)}" if i % 2 else say(50) + f" {rng.randrange(3000)}") for i in range(400)]
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    caught = [r.n_found > 0 for r in got if r.doc_id % 2]
    assert sum(caught) / len(caught) >= 0.9 and not any(r.n_found for r in got if r.doc_id % 2 == 0)
    for r in got:
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
        text = dict(rows)[r.doc_id]
        assert all(text[int(a) : int(b)].strip() for _, a, b in spans)
        assert r.n_found == len(spans) + r.n_secret
