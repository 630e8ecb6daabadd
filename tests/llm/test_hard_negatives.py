import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import hard_negatives as op

SCHEMA = "vec_id long, embedding array<float>, label int, row string"


def wanted(rows):
    """Every anchor against every row, with Python integers."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))

    def order(found):
        return sorted(found, key=lambda f: (-f[1], f[0] is not None, f[0] or 0))

    out = []
    for a, (anchor, label, vector) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [
            (i, l, max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(vector, v)))))
            for b, (i, l, v) in enumerate(kept)
            if b != a
        ]
        for positive, p in order([(i, s) for i, l, s in scored if l == label])[:5]:
            hard = [(i, s) for i, l, s in scored if l != label and 80 * p <= 100 * s <= 100 * p]
            out += [(anchor, positive, n, i, p, s) for n, (i, s) in enumerate(order(hard)[:5], 1)]
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    out = op.digest(df)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert out.schema["rank"].dataType.simpleString() == "int"
    return sorted((tuple(r) for r in out.collect()), key=repr)


def drawn(n, seed, dims=6, labels=3, size=1.0):
    rng = random.Random(seed)
    return [
        (i * 25, [float(np.float32(rng.choice([rng.gauss(0, size), size / 2]))) for _ in range(dims)], rng.randrange(labels))
        for i in range(n)
    ]


@pytest.mark.parametrize("size", [0.2, 300.0, 2.0e9, 1e30])
def test_like_brute_force_at_any_magnitude(spark, size):
    rows = drawn(90, 5, size=size)
    want = wanted(rows)
    assert len(want) > 10
    assert run(spark, rows) == want


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(op, "LEAST_ROWS", 7)
    monkeypatch.setattr(op, "BLOCK_ROWS", 9)
    rows = drawn(120, 6)
    assert run(spark, rows) == wanted(rows)


def test_odd_rows(spark):
    rows = drawn(60, 7, dims=4)
    rows += [
        (100, None, 1), (200, [1.0, None, 0.0, 0.0], 1), (300, [float("nan")] * 4, 1),
        (400, [float("inf"), 0.0, 0.0, 0.0], 1), (500, [1.0, 1.0, 1.0, 1.0], None),
        (600, [], 1), (700, [1.0, 1.0], 0), (800, [2.0, 2.0, 2.0, 2.0, 2.0, 2.0], 0),
        (None, [1.0, 1.0, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0, 1.0], 0), (-100, [1.0, 0.5, 0.5, 1.0], 1),
    ]
    assert run(spark, rows) == wanted(rows)


def test_repeated_rows_and_ties(spark):
    rows = [(i % 4 * 100, [1.0, 0.5], i % 2) for i in range(40)] + [(i, [1.0, 0.5], 2) for i in range(1, 6)]
    assert run(spark, rows) == wanted(rows)


def test_empty_table_and_no_anchor(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


@pytest.mark.parametrize("magnitude", [3, 2**20, 2**70])
def test_packed_products_are_exact(magnitude):
    rng = random.Random(magnitude)
    whole = np.int64 if magnitude < 2**60 else object
    cells = np.array([[rng.randrange(-magnitude, magnitude + 1) for _ in range(5)] for _ in range(30)], dtype=whole)
    anchor = [rng.randrange(-9, 10) for _ in range(5)]
    got = op.Packed(cells, 9).scores(anchor)
    want = [sum(a * int(x) for a, x in zip(anchor, row)) for row in cells]
    assert got.tolist() == [max(-(2**63) + 1, min(2**63 - 1, w)) for w in want]


def test_other_anchors_and_sizes(spark):
    df = spark.createDataFrame([(*r, "x") for r in drawn(60, 8)], SCHEMA)
    found = op.mine(df, F.col("vec_id") < 200, positives=2, negatives=1, least_pct=50)
    assert {r["rank"] for r in found.collect()} == {1}
    assert found.groupBy("anchor_id").count().agg(F.max("count")).first()[0] <= 2
