import random
import re

import duckdb
import pytest

from spendlens.llm import quality_rules as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or len(hit) * 100 > len(words) * 50
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed,
    )


def test_counts_equal_brute_force(docs, noisy_texts):
    texts = [*noisy_texts(1, longest=200), None, "", " \n ", "a\x0bb #1 \n\n x\nx\n x", "a b c a b c a", "é<>&|%$*#" * 3]
    texts += ["\n".join(f"line {i % 5} tail\x0c{i}" for i in range(60))]
    got = {r.doc_id: tuple(r)[1:7] for r in op.digest(docs(*enumerate(texts))).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def hosted(docs):
    def text(seed, n=60):
        return " ".join(f"w{seed}x{i}" for i in range(n))

    boiler = "Read  MORE about our newsletter and the cookies that we set"
    menu = "\n".join(" ".join(f"m{i}k{j}" for j in range(14)) for i in range(20))
    rows = [(i, f"{menu}\n{text(i)}\n{boiler}", "a") for i in range(30)]  # common line, documents differ
    rows += [(100 + i, f"{text('c')}\n{text('d')}\n{text('e')}", "a") for i in range(40)]  # exact copies
    rows += [(200 + i, f"{text('f')}\n{text('g')}\n{text('h')}\nedit {i}", "a") for i in range(20)]  # near copies
    rows += [(240 + i, f"{text('p')}\n{text('q')}\nedit {i}", "a") for i in range(21)]  # one more than the limit
    rows += [(300, f"own words {text(300, 40)}\n{menu}", "a")]  # little of its own
    rows += [(400, f"{boiler.upper()}\n{text(400)}", "b"), (401, f"{text(1)}\n{boiler}", None)]
    return docs(*rows)


def test_line_frequency(hosted):
    out = {r.doc_id: r for r in op.assess(hosted).collect()}
    assert sorted(i for i, r in out.items() if not r.kept) == [*range(30), *range(240, 261), 300] and out[300].depleted and not out[300].base_failed
    assert out[5].clean_text == out[5].text.split("\n")[20] and out[5].n_line_words == 20 * 14 + 11
    for i in (100, 200, 400, 401):  # copies, few near copies, another host, no host
        assert out[i].clean_text == out[i].text


def test_a_long_notice_does_not_hide_shared_lines(docs):
    notice, second = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("n", 60), ("s", 50)))
    menu = "home news about contact"

    def own(i):
        return "\n".join(" ".join(f"w{i}x{k}y{j}" for j in range(10)) for k in range(2))

    rows = [(i, f"{menu}\n{own(i)}\n{notice}\n{second}", "a") for i in range(30)]
    out = op.assess(docs(*rows)).collect()
    assert all(r.clean_text == own(r.doc_id) and r.n_line_words == 114 and r.depleted for r in out) and len(out) == 30


def test_a_crowd_of_copies_does_not_hide_a_footer(docs):
    def text(seed):
        return " ".join(f"w{seed}x{i}" for i in range(60))

    footer = "read more about our newsletter"
    rows = [(i, f"{text('c')}\n{footer}", "a") for i in range(60)]
    rows += [(100 + i, f"{text(i)}\n{footer}", "a") for i in range(50)]
    out = op.assess(docs(*rows)).collect()
    assert all("newsletter" not in r.clean_text and r.kept for r in out) and len(out) == 110


@pytest.mark.parametrize("pages", [100, 21])
def test_pages_that_are_mostly_one_notice_lose_it_and_go(docs, pages):
    notice = " ".join(f"n{i}" for i in range(90))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(7)) + "\n" + notice, "a") for i in range(pages)]
    out = op.assess(docs(*rows)).collect()
    assert len(out) == pages and all(r.n_line_words == 90 and r.depleted and not r.kept for r in out)
    few = op.assess(docs(*rows[:20])).collect()
    assert all(r.kept and r.n_line_words == 0 for r in few)


@pytest.mark.parametrize("pages", [400, 1500])
def test_a_footer_goes_whatever_the_size_of_the_host(docs, pages):
    rng = random.Random(pages)
    stock = [" ".join(f"s{i}y{j}" for j in range(4)) for i in range(12)]
    footer = " ".join(f"f{i}" for i in range(20))

    def own(i):
        words = [f"own{i}x{j}" for j in range(40)]
        return " ".join([*words, *rng.sample(stock, 5)])

    out = op.assess(docs(*((i, f"{own(i)}\n{footer}", "a") for i in range(pages)))).collect()
    assert len(out) == pages and all(r.kept and r.n_line_words == 20 and r.clean_text == r.text.split("\n")[0] for r in out)


def test_a_long_text(docs):
    text = "\n".join(f"line {i} of a long text with its own words {i * 7}" for i in range(60_000))
    out = op.assess(docs((1, text), (2, "short"))).collect()
    assert {r.doc_id: r.n_words for r in out} == {1: 660_000, 2: 1}


def test_kept_rows_have_the_columns_of_documents(hosted):
    out = op.keep_good(hosted)
    assert out.columns == hosted.columns and out.count() == hosted.count() - 52


def test_equals_sql(spark, hosted):
    con = duckdb.connect()
    con.register("documents", hosted.toArrow())
    want = con.sql(op.SQL)
    assert sorted(want.fetchall()) == sorted(map(tuple, op.digest(hosted).select(*want.columns).collect()))


def test_odd_rows_and_columns(docs):
    frame = docs((None, "a b"), (1, None), (2, "x " * 60), (2, "x " * 60)).selectExpr(
        "*", "1 as kept", "'y' as words", "2 as line", "3 as bad", "4 as host", "5 as whole"
    )
    out = op.assess(frame).collect()
    assert len(out) == 4 and not any(r.kept for r in out) and {r.rest.bad for r in out} == {3}
    assert op.keep_good(frame).collect() == []
    assert op.digest(frame.limit(0)).collect() == []


def test_no_python_in_the_plan(docs):
    plan = op.digest(docs("a"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
