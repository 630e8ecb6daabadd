"""The pipeline stage by stage, each on what the one before it kept, against the operators' brute force."""

import hashlib
import random

import pytest

import corpus_pipeline

from . import test_decontamination, test_ngram_join, test_quality_rules, test_substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + (".\n" if rng.random() < 0.05 else "") for _ in range(n))

    items = [(i, prose(30)) for i in range(5)]
    shared = prose(60)
    clean = [prose(rng.randrange(80, 200)) for _ in range(40)]
    near = clean[0].split()
    near[5] = "edited"
    texts = [
        *clean, clean[1], clean[1], " ".join(near), f"{prose(90)} {shared}", f"{shared} {prose(120)}",
        f"{prose(100)} {items[2][1].upper()} {prose(20)}", "too short", None, "", "spam and eggs " * 60,
    ]
    rows = [(i, t, "en", [None, "b", "a", "c"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_every_stage_equals_brute_force(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "mixing sources"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        if name != "mixing sources":
            assert out.columns == docs.columns
        rows = out.collect()
        after = {r.doc_id: getattr(r, "text", None) for r in rows}
        assert len(rows) == len(after)
        if name == "quality rules":  # too few documents for a frequent line
            assert after == {i: t for i, t in before.items() if not test_quality_rules.brute(t)[5]}
        elif name == "n-gram Jaccard join":
            want = test_ngram_join.brute(list(before.items()))
            assert after == {r[0]: before[r[0]] for r in want if r[0] == r[1]}
        elif name == "substring dedup":
            want = {r[0]: r[3] for r in test_substring_dedup.brute(list(before.items()))}
            assert {i: sha(t) for i, t in after.items()} == want
        elif name == "benchmark decontamination":
            want = test_decontamination.brute(list(before.items()), items)
            assert after == {r[0]: before[r[0]] for r in want if not r[5]}
        else:
            assert sorted(after) == sorted(before)
            assert {r.doc_id: r.size for r in rows} == {i: len(t.split()) for i, t in before.items()}
        seen.append(len(rows))
        path = f"{sf_dir}/{len(seen)}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert seen[0] > seen[1] > seen[3] == seen[4] >= 40


def test_run_gives_the_last_stage(spark, sf_dir):
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) for _ in range(2))
    assert a == b and len(a) >= 40
