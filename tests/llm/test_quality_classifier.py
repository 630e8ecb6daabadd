import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import quality_classifier as op
from spendlens.llm.text import SPACES, Words, column_bytes, lots

from ..conftest import SMALL

LABELS = "doc_id long, quality int, toxic int"


def spaced(text):
    return [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]


def slow_units(text):
    """Words, pairs and n-grams of characters of a text, as strings."""
    units, words = Counter(), spaced(text)
    for word in words:
        units["w", word] += 1
        marked = f"<{word}>"
        for n in op.GRAMS:
            units.update(("g", marked[i : i + n]) for i in range(len(marked) - n + 1))
    units.update(("p", "=", "=") if a == b else ("p", a, b) for a, b in zip(words, words[1:]))
    return units


def as_bytes(text):
    return np.frombuffer(text.encode(), np.uint8)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_units_like_strings(noisy_texts):
    buckets = 1 << 40  # so many that no two units share one
    for text in [*noisy_texts(3, n=12), "", " ", "a", "ab ab ab", "über的的的 x"]:
        want = slow_units(text)
        data = as_bytes(text)
        units = op.Units(data, np.array([0, len(data)]), buckets=buckets)
        got = Counter(units.pairs.tolist())
        for word in units.word.tolist():
            start = units.starts[word]
            got.update(units.buckets[start : start + units.per_word[word]].tolist())
        assert sorted(got.values()) == sorted(want.values())


def test_a_long_text_in_pieces_is_the_whole_text(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcü") for _ in range(rng.randrange(1, 9))) for _ in range(3000))
    text += " " + "x" * 5_000 + " end"
    data, offsets = as_bytes("first " + text), np.array([0, 6, 6 + len(as_bytes(text))])
    whole = list(lots(data, offsets, 1 << 20, SPACES))
    parts = list(lots(data, offsets, 700, SPACES))
    assert len(whole) == 1 and len(parts) > 20
    assert np.array_equal(np.concatenate([p[0] for p in parts]), data)
    # no word is cut: the parts have the words of the whole
    assert sum(len(Words(p, o)) for p, o, _ in parts) == len(Words(data, offsets))
    logits = np.random.default_rng(2).normal(size=(1 << 12, 2))
    want = op.probabilities(data, offsets, logits, np.zeros(2))
    monkeypatch.setattr(op, "PIECE", 700)
    got = op.probabilities(data, offsets, logits, np.zeros(2))
    assert np.allclose(got, want, atol=0.01)  # but for the pairs at the cuts


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SMALL}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/../sf0.01/labels.parquet")
    return docs, labels, op.digest(docs, labels).collect()


def test_held_out_accuracy(scored):
    docs, labels, rows = scored
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    unseen = [r for r in rows if r.held_out and r.doc_id in quality]
    assert len(unseen) > 60 and {quality[r.doc_id] for r in unseen} == {0, 1}
    assert sum(r.predicted == quality[r.doc_id] for r in unseen) >= 0.95 * len(unseen)
    good = [r.score for r in unseen if quality[r.doc_id] == 1]
    bad = [r.score for r in unseen if quality[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_labels_of_held_out_rows_do_not_matter_nor_does_order(spark, scored):
    docs, labels, rows = scored
    other = F.when(F.col("doc_id").isin([i for i in range(1000) if held_out(i)]), 1 - F.col("quality"))
    changed = labels.withColumn("quality", F.coalesce(other, "quality")).repartition(5)
    again = op.digest(docs.repartition(6).withColumn("lang", F.lit("x")), changed).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


def test_odd_rows(spark, docs):
    some = [(i, "good words here and there" if i % 2 else "bad! bad! bad!") for i in range(40)]
    odd = [(100, None), (101, ""), (102, " \n\t"), (None, "good words"), (103, "good words"), (103, "bad! bad!"), (104, "x" * 3_000_000)]
    rows = [(i, i % 2, 0) for i in range(40)] + [(1, 1, 1), (None, 1, 0), (103, None, 0), (104, 7, 0), (999, 1, 0)]
    labels = spark.createDataFrame(rows, LABELS).withColumn("text", F.lit("x"))
    table = docs(*some, *odd).withColumn("quality", F.lit(1)).withColumn("score", F.lit(1))
    out = op.digest(table, labels).collect()
    assert len(out) == 47
    score = {}
    for r in out:
        score.setdefault(r.doc_id, []).append(r.score)
    assert score[100] == score[101] == score[102] and score[None][0] in score[103]
    assert min(score[1]) > 0.7 > 0.3 > max(score[2])
    assert [r.held_out for r in out if r.doc_id is None] == [zlib.crc32(b"") % 4 == 2]


def test_no_labels_and_no_documents(spark, docs):
    none = spark.createDataFrame([], LABELS)
    out = op.digest(docs("a b", None), none).collect()
    assert [(r.score, r.predicted) for r in out] == [(0.5, 0)] * 2
    assert op.digest(docs("a").limit(0), none).collect() == []
    one = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert all(r.score > 0.5 for r in op.digest(docs("a b", "a c"), one).collect()) or held_out(1)


def test_the_bound_takes_the_least_hashes(spark, docs, monkeypatch):
    table = docs(*[f"word{i} " * 20 for i in range(30)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], LABELS)
    taught = [r.doc_id for r in op._taught(table, labels, 5).collect()]
    order = [r.doc_id for r in table.orderBy(F.xxhash64("doc_id")).collect() if not held_out(r.doc_id)]
    assert sorted(taught) == sorted(order[:5])
    monkeypatch.setattr(op, "TRAINED_UNITS", 400)
    assert 0 < op._taught(table, labels, 5).count() < 5


def test_column_bytes_of_no_rows(spark, docs):
    assert len(column_bytes(docs("a").limit(0).toArrow()["text"])[0]) == 0
