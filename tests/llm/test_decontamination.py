import hashlib
import random
import re

import pytest

from spendlens.llm import decontamination as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(rows, items, window=10):
    shapes = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            shapes.setdefault(tuple(w[k : k + window]), set()).add("" if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for size in {len(s) for s in shapes}:
            for k in range(len(w) - size + 1):
                ids = shapes.get(tuple(w[k : k + size]))
                if ids:
                    hit.update(range(k, k + size))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    vocabulary = ["the", "The", "of", "x1", "ü", "Ñandú", "a", "的", "QED"]
    glue = [" ", ", ", "\n", "-", " «", "_", "\x00", "  "]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice(glue) for _ in range(n))

    items = [(i, text(rng.choice([4, 9, 10, 11, 30, 30]) if i % 7 else 12)) for i in range(30)]
    items += [(30, items[5][1]), (31, None), (32, "!!"), (None, text(14)), (8, text(13))]
    items = [(i, t) for i, t in items if len(words(t)) != 1]
    rows = []
    for i in range(40):
        t = text(rng.randrange(30))
        if i % 3 == 0:
            w = words(rng.choice(items)[1])
            t += "; ".join(w[: rng.randrange(8, 40)]).upper() if i % 2 else " ".join(w)
        rows.append((i, t + text(rng.randrange(20))))
    rows += [(40, None), (41, ""), (42, "…"), (None, rows[3][1]), (3, rows[3][1]), (3, "other")]
    return rows, items


@pytest.fixture(scope="module")
def bench(spark, case):
    return spark.createDataFrame(case[1], "item_id long, text string")


def test_equals_brute_force(docs, bench, case):
    got = sorted(map(tuple, op.digest(docs(*case[0]), bench).collect()), key=repr)
    assert got == brute(*case) and any(r[2] > 10 for r in got)


def test_lots_change_nothing(docs, bench, case):
    frame = docs(*case[0])
    columns = ["doc_id", "n_words", "hits", "spans", "items"]
    whole, lots = op.scan(frame, bench).select(columns), op.scan(frame, bench, lot_bytes=400).select(columns)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, lots.collect()), key=repr)


def test_spans_are_places_in_the_original(docs, bench, case):
    for r in op.scan(docs(*case[0]), bench).collect():
        for span, hit in zip(r.spans, r.hits, strict=True):
            assert words(r.text[span.start : span.end]) == words(r.text)[hit.first : hit.last + 1]


def test_odd_tables(spark, docs, bench):
    frame = docs("a b", None).selectExpr("*", "1 as items", "2 as rest", "3 as n_words")
    clean = op.keep_clean(frame, bench)
    assert clean.columns == frame.columns and clean.count() == 2
    assert op.digest(frame.limit(0), bench).collect() == []
    assert [r.contaminated for r in op.digest(frame, bench.limit(0)).collect()] == [False, False]


def test_contaminated_documents_go(docs, bench, case):
    want = sorted([r[0] for r in brute(*case) if not r[5]], key=repr)
    assert sorted([r.doc_id for r in op.keep_clean(docs(*case[0]), bench).collect()], key=repr) == want


def test_long_text(docs, bench, case):
    passage = case[1][0][1]
    assert len(words(passage)) >= 10
    (row,) = op.digest(docs("q " * 50_000 + passage + " q" * 50_000), bench).collect()
    assert row.n_words == 100_000 + len(words(passage)) and row.contaminated
