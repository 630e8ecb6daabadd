import hashlib
import re

import pytest

from spendlens.llm import substring_dedup as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    words = [(i, WORD.findall(t or "")) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    seen, out = set(), {}
    for i, own in words:
        gone = set()
        for at in range(len(own) - window + 1):
            run = tuple(own[at : at + window])
            if run in seen:
                gone.update(range(at, at + window))
            seen.add(run)
        kept = [w for at, w in enumerate(own) if at not in gone]
        out.setdefault(i, []).append((len(own), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(((i, *x) for i, rows in out.items() for x in rows), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(docs, noisy_texts, seed):
    texts = noisy_texts(seed, vocabulary=3 + seed)
    rows = [((i * 7) % 41, t) for i, t in enumerate(texts)]
    got = sorted((tuple(r) for r in op.digest(docs(*rows)).collect()), key=repr)
    assert got == brute(rows)
    assert sum(r[2] for r in got)


def test_small_blocks_change_nothing(docs, noisy_texts):
    rows = list(enumerate(noisy_texts(9)))
    frame = docs(*rows)
    a = op.remove_repeats(frame).select("doc_id", "text", "n_removed").collect()
    b = op.remove_repeats(frame, block_bytes=200).select("doc_id", "text", "n_removed").collect()
    assert sorted(a) == sorted(b)


def test_odd_rows_and_columns(spark, docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(None, "q " * 25), (1, None), (1, ""), (2, long), (3, long), (4, "q " * 25), (4, "q " * 25), (5, " \n\t")]
    got = sorted((tuple(r) for r in op.digest(docs(*rows)).collect()), key=repr)
    assert got == brute(rows)
    clash = docs("a b", "a b").selectExpr("doc_id", "text", "1 as block", "'x' as rest", "2 as part", "3 as n_words_")
    assert sorted(map(tuple, op.remove_repeats(clash).collect())) == [(i, "a b", 1, "x", 2, 3, 2, 0) for i in range(2)]
    assert op.digest(docs("x").limit(0)).collect() == []


def test_the_earliest_stays_whole(docs):
    passage = " ".join(f"p{i}" for i in range(40))
    out = {r.doc_id: r.text for r in op.remove_repeats(docs(f"one {passage}", f"{passage} two", f"x {passage} y")).collect()}
    assert out == {0: f"one {passage}", 1: "two", 2: "x y"}
