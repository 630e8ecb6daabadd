import os
import random
from collections import defaultdict

import duckdb
import pytest

from spendlens.llm import html_extraction as op

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def texts(spark):
    def make(*rows, parts=3):
        frame = spark.createDataFrame(list(rows), PAGES).repartition(parts)
        return {r.page_id: r.text for r in op.digest(frame).collect()}

    return make


def longest(a, b):
    """Lengths of longest common subsequences of all starts."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best


def plainly(pages):
    """The contract of extraction for pages (id, host, path, lines of (in an article, text)), each at its own
    place, whose lines differ inside a page: so a longest common subsequence is the only one if the lines that
    two pages share have one order in both."""
    by_host, on_hosts = defaultdict(list), defaultdict(set)
    for number, host, path, lines in pages:
        by_host[host].append((path, number, lines))
        for _, text in lines:
            on_hosts[text].add(host)
    out = {}
    for own in by_host.values():
        own.sort(key=lambda p: (p[0].encode(), p[1]))
        contents = {tuple(t for _, t in lines) for _, _, lines in own}
        for k, (path, number, lines) in enumerate(own):
            near = [own[j] for j in (k - 1, k + 1) if 0 <= j < len(own)]
            near.sort(key=lambda p: -len(os.path.commonprefix([p[0], path])))
            theirs = [t for _, t in near[0][2]] if near else []
            frame = {t for _, t in lines if (n := sum(t in c for c in contents)) >= 5 and 2 * n >= len(contents)}
            both = {t for _, t in lines if t in theirs} - frame
            assert longest([t for _, t in lines], theirs)[-1][-1] == sum(t in theirs for _, t in lines)
            size = sum(len(t) for _, t in lines if t not in frame)
            if sum(map(len, both)) * 100 >= 60 * size:
                both = set()
            gone = frame | {t for inside, t in lines if t in both and not (inside and len(on_hosts[t]) > 1)}
            marked = any(inside for inside, _ in lines)
            out[number] = "\n".join(t for inside, t in lines if t not in gone and (inside or not marked))
    return out


def article(body, frame="site"):
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        f"<header>{frame} head</header><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy</div>"
        f"<div id=cookie-notice>We set</div><article>{body}</article><aside>Side</aside><section class='comments'><p>First!</p></section>"
        f"<form><label>Mail</label><input></form><footer>&copy; {frame}</footer></body></html>"
    )


def test_article_without_its_frame(texts):
    body = (
        "<h1>A &amp; B</h1><p><b>One\n two&nbsp;&nbsp;three<br><p>un<i>broken</i> &lt;tag&gt; &#233;&#x4e2d;</p>"
        "<ul><li>x<li>y</ul><div class='with-sidebar'>kept</div><p class=share-bar>Share</p><p hidden>h</p><table><tr><td>c1<td>c2</table>"
    )
    got = texts((1, "http://a/x", article(body)))
    assert got[1] == "A & B\nOne two three\nunbroken <tag> é中\nx\ny\nkept\nc1\nc2"


def test_differencing_without_an_article(texts):
    page = "<body><div>Welcome to our site</div><p>{0} own words</p><div>All about us</div><p>{0} more</p><p>Call now</p>"
    rows = [(i, f"http://host/a/{i:03}", page.format(f"page {i} with a text that is much longer than the rest of it")) for i in range(40)]
    rows += [(50, "http://other/a/001", page.format("alone")), (51, None, page.format("no url"))]
    for parts in (1, 7):
        got = texts(*rows, parts=parts)
        assert all(got[i].count("\n") == 1 and "Welcome" not in got[i] and f"page {i} " in got[i] for i in range(40))
        assert got[50].startswith("Welcome") and got[51].startswith("Welcome")


def test_a_short_text_in_a_large_frame(texts):
    frame = "".join(f"<div>Menu entry {k} that every page of this host has in its frame</div>" for k in range(9))
    got = texts(*((i, f"http://h/a/{i:02}", f"{frame}<p>Page {i} is short</p><div>All about us</div>") for i in range(20)))
    assert got == {i: f"Page {i} is short" for i in range(20)}


def test_frame_inside_an_article(texts):
    body = "<p>Page {0} has a text of its own</p><p>as page {1} says</p><p>Subscribe to our letter for more of this</p>"
    rows = [(i, f"http://h/a/{i:02}", article(body.format(i, i // 2))) for i in range(20)]
    got = texts(*rows, *((100 + i, f"http://g/{i}", article("<p>A copy of an article</p>")) for i in range(9)))
    pair = {i: f"\nas page {i // 2} says" for i in range(2, 20, 2) if i != 10}  # page 2 meets 1, page 10 meets 11
    assert got == {i: f"Page {i} has a text of its own{pair.get(i, '')}" for i in range(20)} | dict.fromkeys(
        range(100, 109), "A copy of an article"
    )


def test_shared_lines_inside_articles(texts):
    body = "<p>Page {0} has a text of its own</p><p>Sign up for the letter of this site</p>"
    own = {i: f"Page {i} has a text of its own" for i in range(4)}
    rows = [(i, f"http://h/a/{i}", article(body.format(i))) for i in range(4)]
    assert texts(*rows) == own
    few = [(i, f"http://h/a/{i:02}", article(body.format(i) if i < 9 else f"<p>Page {i} is another</p>")) for i in range(20)]
    assert all("Sign" not in text for i, text in texts(*few).items())
    # another host has the line as well: quoted text, which stays
    quoted = texts(*rows, (9, "http://other/", article("<p>Sign up for the letter of this site</p>")))
    assert {quoted[i] for i in own} == {f"{own[i]}\nSign up for the letter of this site" for i in own}


def test_sites_equal_brute_force(texts):
    rng = random.Random(8)
    stock = [f"Stock line {k} that some pages of some hosts carry" for k in range(12)]
    pages = []
    for number in range(150):
        host, marked = rng.choice("ab" if number % 3 else "cdefgh"), rng.random() < 0.6
        chosen = sorted(rng.sample(range(len(stock)), rng.randrange(5)))
        lines = [stock[k] + (f" of {host}" if k % 2 else "") for k in chosen]
        for place in range(rng.randrange(4)):
            lines.insert(rng.randrange(len(lines) + 1), f"Page {number} says {place} " + "words " * rng.randrange(12) + "here")
        if marked:
            cut = sorted(rng.sample(range(len(lines) + 2), 2))
            lines = [(cut[0] <= i < cut[1], t) for i, t in enumerate(lines)]
        else:
            lines = [(False, t) for t in lines]
        pages.append((number, host, f"/{rng.choice('xyz')}/{number * 7919 % 1000}", lines))
    rows = []
    for number, host, path, lines in pages:
        html = "".join(f"<article><p>{t}</p></article>" if inside else f"<p>{t}</p>" for inside, t in lines)
        rows.append((number, f"https://{host}{path}?q#f", f"<html><body>{html}</body></html>"))
    want = plainly(pages)
    for parts in (1, 5):
        assert texts(*rows, parts=parts) == want


def test_copies_keep_their_lines(texts):
    page = "<p>The same text on both pages, every word of it</p><p>and more</p>"
    got = texts(*((i, f"http://h/p{i}", page) for i in range(3)), (3, "http://h/q", article("<p>All about us</p>")), (4, "http://h/r", article("<p>All about us</p>")))
    assert set(got.values()) == {"The same text on both pages, every word of it\nand more", "All about us"}


def test_nearest_path_wins():
    row = {"host": "h", "path": "/en/12", "lines": [1, 2, 3], "sizes": [1, 1, 9], "inner": [False] * 3, "frame": None}
    before = {"host": "h", "path": "/de/9", "lines": [2]}
    after = {"host": "h", "path": "/en/1x", "lines": [1]}
    import pyarrow as pa

    def shared(b, a):
        batch = pa.RecordBatch.from_pylist([row | {"page_id": 1, "print": 2, "before": b, "after": a}])
        return next(op._differenced(iter([batch])))["shared"].to_pylist()[0]

    assert shared(before, after) == [0]
    assert shared(before, after | {"host": "g"}) == [1]
    assert shared(before, after | {"path": "/x"}) == [1]


def test_longest_common_subsequence():
    rng = random.Random(2)
    for most in (5, 5, 2, 30):
        for _ in range(150):
            a, b = ([rng.randrange(most) for _ in range(rng.randrange(12 if most > 2 else 90))] for _ in range(2))
            got = op.common(a, b)
            assert len(got) == longest(a, b)[-1][-1] and all(a[i] == b[j] for i, j in got)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
            assert list(op._lengths(a, b)) == longest(a, b)[-1]


def test_many_repeated_lines():
    """Work by pairs would be 1.25 thousand million steps."""
    a, b = [i % 2 for i in range(50_000)], [i % 2 for i in range(1, 50_001)]
    assert len(op.common(a, [7, *b[:30_000], 8, *b[30_000:]])) >= 49_998


def test_odd_rows(spark, texts):
    long = "<p>" + "word " * 300_000
    got = texts((1, "u", None), (2, "u", ""), (None, "u", "<p>x"), (3, None, long), (4, "u", "a < b &am <p"), (5, "u", "<nav>only"))
    assert got == {1: "", 2: "", None: "x", 3: ("word " * 300_000).strip(), 4: "a < b &am", 5: ""}
    twice = spark.createDataFrame([(1, "u", "<p>x")] * 2, PAGES).selectExpr("*", "1 as print", "2 as text", "3 as shared")
    assert [(r.text, r.rest.text) for r in op.extract(twice).collect()] == [("x", 2)] * 2
    assert op.digest(twice.limit(0)).collect() == []


def test_given_pages_equal_their_articles(spark):
    """On the given pages, whose text is the article element, against a plain reading with SQL."""
    path = "/root/testdata/sf0.001/pages.parquet"
    want = duckdb.sql(
        f"""SELECT page_id, regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'),
            '</?(h1|p)>', chr(10), 'g'), '<[^>]*>', '', 'g') FROM '{path}'"""
    ).fetchall()
    import html

    plain = {i: "\n".join(" ".join(html.unescape(x).split()) for x in t.split("\n") if x.strip()) for i, t in want}
    got = {r.page_id: (r.text, r.n_chars) for r in op.digest(spark.read.parquet(path)).collect()}
    assert got == {i: (t, len(t)) for i, t in plain.items()}
