import random
import re

import duckdb
import pytest

from spendlens.llm import license_scan as op

FILL = [f"word{i}" for i in range(50)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    out = [None, "", "MIT", "Released under the MIT", "released UNDER the\n** mit-license", "…«»"]
    for name, text in op.TEMPLATES.items():
        words = text.split()
        for edits in (0, 1, 3, len(words) // 2):
            own = list(words)
            for _ in range(edits):
                own[rng.randrange(len(own))] = "changed"
            before, after = (" ".join(rng.choices(FILL, k=rng.randrange(200))) for _ in range(2))
            out.append(f"{before} {' '.join(own)} {after}")
    return [*out, out[-4] * 2, "x " * 60_000 + op.TEMPLATES["mit-permission"] + " y" * 60_000]


def test_equals_sql(spark, docs, texts):
    frame = docs(*enumerate(texts))
    con = duckdb.connect()
    con.register("documents", frame.toArrow())
    want = {r[0]: r[1:] for r in con.sql(op.SQL).fetchall()}
    got = {r.doc_id: (r.n_licenses, r.licenses) for r in op.digest(frame).collect()}
    assert got == want
    assert {n for _, names in got.values() for n in names.split(",") if n} == set(op.TEMPLATES)


def test_windows_name_their_place(docs, texts):
    for r in op.scan(docs(*enumerate(texts))).collect():
        words = re.findall(r"[^\W_]+", (r.text or "").lower())
        for w in r.windows:
            assert w.license in r.licenses and w.containment >= op.CONTAINED
            held = " ".join(words[w.first : w.last + 1])
            assert set(re.findall(r"[^\W_]+", op.TEMPLATES[w.license].lower())) & set(held.split())


def test_bands_keep_the_recall():
    least = 0.8 * 0.5 / 2.1
    assert 1 - (1 - least) ** op.bands() >= op.RECALL > 1 - (1 - least) ** (op.bands() - 1)


def test_odd_rows_and_columns(spark, docs):
    mit = op.TEMPLATES["mit"]
    frame = docs((None, mit), (1, mit), (1, mit), (2, "none")).selectExpr("*", "1 as licenses", "2 as print", "3 as at")
    out = sorted(((r.doc_id, r.licenses, r.rest.at) for r in op.scan(frame).collect()), key=repr)
    assert out == [(1, ["mit"], 3), (1, ["mit"], 3), (2, [], 3), (None, ["mit"], 3)]
    assert op.digest(frame.limit(0)).collect() == []
    none = op.scan(frame, spark.createDataFrame([("short", "a b")], "license string, text string"))
    assert [r.licenses for r in none.collect()] == [[]] * 4


def test_no_python_in_the_plan(docs):
    plan = op.digest(docs("a"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_a_text_of_a_million_words(docs):
    """In proportion to its words: rows that carried the text once a window took minutes."""
    filler = "x " * 400_000
    text = f"{filler}{op.TEMPLATES['mit']} {filler}{op.TEMPLATES['apache-2.0-header']} {filler}"
    row = op.scan(docs((1, text))).first()
    assert row.licenses == ["apache-2.0", "apache-2.0-header", "mit"]
    assert {w["first"] // 400_000 for w in row.windows} <= {0, 1, 2}
