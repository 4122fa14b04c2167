"""The pipeline's stages against brute force, and its queries' registration."""

import random
import re

import corpus_pipeline
from lakeloom.llm import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(tmp_path, spark):
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(n))
    docs, labels, items = [], [], [(1, say(30)), (2, say(40))]
    for i in range(240):
        t, toxic = say(rng.randrange(30, 90)), i % 6 == 0
        if toxic:
            t += " nastyword vilething nastyfolk"
        docs.append((i, t, "en", f"s{i % 3}", len(t)))
        labels.append((i, 1, int(toxic)))
    clean = [d for d in docs if d[0] % 6]
    extra = {"exact": [], "near": [], "leak": []}
    for n, d in enumerate(clean[:20]):
        extra["exact"].append((1000 + n, d[1].upper(), *d[2:]))
    for n, d in enumerate(clean[30:50]):
        extra["near"].append((2000 + n, d[1] + " zz", *d[2:]))
    for n, (_, t) in enumerate(items * 3):
        extra["leak"].append((3000 + n, say(20) + " " + t + " " + say(9), "en", "s0", 1))
    docs += [x for v in extra.values() for x in v] + [(9000, None, None, None, None), (9001, "", "en", "s1", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs, extra, clean


def test_stages(tmp_path, spark):
    docs, extra, clean = corpus(tmp_path, spark)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in got}
    assert len(ids) == len(got)
    gone = {d[0] for d in docs} - ids
    toxic = {i for i in range(240) if i % 6 == 0}
    exact = {d[0] for d in clean[:20]}  # the copy has the larger id
    near = {d[0] for d in extra["near"]}
    leak = {d[0] for d in extra["leak"]}
    assert gone == toxic | exact | near | leak | {9000}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "mix"]


def test_stages_take_empty_tables(tmp_path, spark):
    corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != "mix":
            assert out.columns == docs.columns


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 11))
    assert set(queries.SQL) <= set(queries.QUERIES)
