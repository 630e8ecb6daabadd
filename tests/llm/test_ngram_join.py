import random
import re

import numpy as np
import pytest

from spendlens.llm import ngram_join as op
from spendlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, threshold=0.8):
    sets = {i: grams(t) for i, t in rows}
    near = {i: set() for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if i != j and a and b and len(a & b) >= threshold * len(a | b):
                near[i].add(j)
    out = []
    for i, a in sets.items():
        group, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - group
            group |= new
            todo += new
        out.append((i, min(group), min([i, *(j for j, b in sets.items() if a and b == a)]), len(near[i]), len(a)))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 60, 200]))] for _ in range(25)]
    out = []
    for base in bases:
        for _ in range(rng.choice([1, 1, 2, 9])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(99)}"
            out.append(" ".join(own))
    out += [None, "", " \n", "a", "a", "a b c d e"]
    return list(enumerate(out, 10))


@pytest.mark.parametrize("block", [512, 3])
def test_equals_brute_force(docs, rows, block):
    got = sorted(map(tuple, op.join(docs(*rows), block=block).collect()))
    assert got == brute(rows)
    assert max(r[3] for r in got) > 3


def test_one_of_each(docs, rows):
    frame = docs(*rows, rows[0], rows[0])
    out = op.one_of_each(frame)
    assert out.columns == frame.columns
    assert sorted(r.doc_id for r in out.collect()) == [r[0] for r in brute(rows) if r[0] == r[1]]


def test_odd_rows(docs):
    text = " ".join(map(str, range(50)))
    frame = docs((None, text), (1, text + " x"), (2, "q"), (3, text), (4, "a b"), (4, "c d")).selectExpr(
        "*", "1 as class", "2 as rep", "3 as node"
    )
    got = {r.doc_id: tuple(r)[1:] for r in op.join(frame).collect()}
    assert got == {None: (None, None, 2, 46), 1: (None, 1, 2, 47), 2: (2, 2, 0, 1), 3: (None, None, 2, 46), 4: (4, 4, 0, 1)}
    assert op.join(frame.limit(0)).collect() == []
    assert [r.doc_id for r in op.one_of_each(frame).orderBy("doc_id").collect()] == [1, 2, 4, 4]


def test_unrelated_rows_without_a_number_of_their_own_all_stay(docs):
    texts = [" ".join(f"{x}{i}" for i in range(30)) for x in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (None, None), (7, None), (7, "")]
    out = op.one_of_each(docs(*rows)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == sorted({(str(i), str(t)) for i, t in rows})
    # a copy under a number of its own goes before one under a shared number
    linked = op.one_of_each(docs(*rows, (9, texts[2] + " tail"), (8, texts[0]))).collect()
    assert {r.doc_id for r in linked if r.text and r.text.startswith(("a0", "c0"))} == {8, 9}


def test_long_text(docs):
    long = " ".join(f"w{i}" for i in range(40_000))
    got = sorted(map(tuple, op.join(docs(long, long + " tail", "short")).collect()))
    assert got == [(0, 0, 0, 1, 39_996), (1, 0, 1, 1, 39_997), (2, 2, 2, 0, 1)]


def test_banding_keeps_the_recall():
    for threshold in (0.5, 0.8, 0.95, 1.0):
        bands, rows = op.banding(threshold)
        assert 1 - (1 - threshold**rows) ** bands >= op.RECALL and bands * rows <= 160


def test_matches_in_slabs(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(12)]
    want = [[len(set(a) & set(b)) >= 0.5 * len(set(a) | set(b)) for b in sets[5:]] for a in sets[:5]]
    monkeypatch.setattr(op, "_SLAB", 7)
    assert op._matches(sets[:5], sets[5:], 0.5).tolist() == want


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    hub = [(1000, 2000 + i) for i in range(50)] + [(7000, 2049), (5, 5)]
    random.Random(2).shuffle(chain)
    got = dict(components(spark.createDataFrame(chain + hub, "src long, dst long")).collect())
    assert {got[i] for i in range(1, 61)} == {1} and {got[n] for n in (1000, 2000, 2049, 7000)} == {1000}
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []
