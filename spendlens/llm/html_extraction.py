"""Main text of web pages, by differencing each page against the nearest page of its host.

Pages are sorted by host and URL path; of a page's two neighbours the one that shares the longer start
of the path is its partner (the one before, if both do). The text lines of both are aligned by longest
common subsequence, and the shared lines, which a site repeats, are deleted.

Differencing alone cannot tell a site's frame from text that two pages truly share as copies, and a
frame that differs on every page escapes it. So the markup also counts: elements that are not main text
by their name, role, class or id are left out before, and if a page marks an article, only that is its
main text. The shared lines go inside an article as well as outside, with two exceptions. A page that has
most of its text in common with its partner, line by line in one order, is a copy of it and keeps these
lines. And a line of an article that another host has too is quoted or copied text and no habit of this
site, so it stays. Lines on at least half of the host's different pages (and on five) are frame and
tell nothing about copies: they go whatever their share of the page.

Sorting is by range over host, path and row, so a host with a third of all pages is many tasks' work;
only line hashes are sorted. Each task's outermost pages meet their neighbours by a table of two rows
a task. No html is exchanged: the lines that can be main text are read from it where it is scanned, and
they alone meet the places of the lines that go.

Defined results: a null or empty html gives an empty text; a null url is a host of its own; pages
without a neighbour on their host lose nothing by differencing; repeated rows are one page in the
order and each gets its result; an empty table gives an empty result; further columns travel untouched.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import written

LEFT_OUT, OUTSIDE, ARTICLE = 0, 1, 2
#: Percentage of a page's text without its frame in shared lines from which its partner counts as a copy.
COPY_PCT = 60
#: A line on so many different pages of a host, and on half of them at least, is its frame.
FRAME_PAGES = 5
#: Equal pairs a line, beyond which an alignment works on bit rows.
_PAIRS = 16
#: Parts of a host's pages that meet its frame in tasks of their own.
_SALTS = 32

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_NEVER_TEXT = frozenset(
    "head title script style noscript template svg iframe object audio video canvas map nav menu footer aside "
    "form button select textarea fieldset datalist dialog search".split()
)
_IN_HEAD = frozenset("head title meta link style script base noscript template".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs footer sidebar aside widget widgets notice cookie cookies "
    "consent gdpr alert popup modal overlay comment comments disqus reply replies respond discussion share "
    "sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "toolbar pager pagination copyright".split()
)
_HEADERS = frozenset("header masthead".split())
_STATES = frozenset("with has no is without".split())
_UNFINISHED = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _named(attributes: dict[str, str | None], words: frozenset[str]) -> bool:
    """Whether a class or id begins or ends with one of the words."""
    for name in f"{attributes.get('class') or ''} {attributes.get('id') or ''}".lower().split():
        parts = re.split(r"[-_]+", name)
        if parts[0] not in _STATES and (parts[0] in words or parts[-1] in words):
            return True
    return False


class _Lines(HTMLParser):
    """(zone, line) for every block of text, in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[int, str]] = []
        self.open: list[tuple[str, int]] = []
        self.parts: list[str] = []

    @property
    def zone(self) -> int:
        return self.open[-1][1] if self.open else OUTSIDE

    def end_line(self) -> None:
        line = " ".join("".join(self.parts).split())
        self.parts.clear()
        if line:
            self.lines.append((self.zone, line))

    def close_to(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in _INLINE:
            self.end_line()
            if tag not in _IN_HEAD:
                self.close_to("head")
            for i in range(len(self.open) - 1, -1, -1):  # a block ends an open paragraph, an item the one before
                name = self.open[i][0]
                if name == "p" or name == tag and tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                    del self.open[i:]
                    break
                if name not in _INLINE:
                    break
        if tag in _VOID:
            return
        zone, own = self.zone, dict(attrs)
        role = (own.get("role") or "").lower()
        if zone == LEFT_OUT or tag in _NEVER_TEXT or role in _ROLES:
            zone = LEFT_OUT
        elif "hidden" in own or own.get("aria-hidden") == "true" or _HIDDEN.search(own.get("style") or ""):
            zone = LEFT_OUT
        elif tag not in ("html", "body", "main") and _named(own, _CLASSES):
            zone = LEFT_OUT
        elif zone != ARTICLE and tag not in ("html", "body", "main") and (tag == "header" or _named(own, _HEADERS)):
            zone = LEFT_OUT
        elif tag in ("article", "main") or role in ("article", "main"):
            zone = ARTICLE
        self.open.append((tag, zone))

    def handle_endtag(self, tag: str) -> None:
        if tag not in _INLINE:
            self.end_line()
        self.close_to(tag)

    def handle_data(self, data: str) -> None:
        if self.zone != LEFT_OUT:
            self.parts.append(data)


def lines_of(html: str | None) -> list[tuple[int, str]]:
    if not html:
        return []
    parser = _Lines()
    parser.feed(_UNFINISHED.sub("", html))
    parser.close()
    parser.end_line()
    return [x for x in parser.lines if x[0] != LEFT_OUT]


def _chained(a: list, b: list, places: dict) -> list[tuple[int, int]]:
    """Every equal pair extends the best chain that ends before it: work by the number of equal pairs."""
    ends: list[int] = []  # least last place in b of a chain of each length
    chains: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            k = bisect_left(ends, j)
            chain = (i, j, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    found, chain = [], chains[-1] if chains else None
    while chain:
        found.append(chain[:2])
        chain = chain[2]
    return found[::-1]


def _lengths(a: list, b: list) -> np.ndarray:
    """Of `a` against every start of `b` the length of a longest common subsequence.

    A row of the table is one integer with a bit for each line of `b`, zero where the length grows; a
    line of `a` moves the whole row by one addition."""
    n = len(b)
    places = _places(b)
    often = {}  # rows of bits of the lines that occur so often that making them anew costs more
    every = row = (1 << n) - 1
    for x in a:
        where = places.get(x)
        if where is None:
            continue
        mask = often.get(x)
        if mask is None:
            if len(where) < 8:
                mask = sum(1 << j for j in where)
            else:
                bits = np.zeros(n, np.uint8)
                bits[where] = 1
                mask = often[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        same = row & mask
        row = ((row + same) | (row - same)) & every
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little", count=n)
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _places(lines: list) -> dict:
    places: dict = {}
    for j, x in enumerate(lines):
        places.setdefault(x, []).append(j)
    return places


def common(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs of places.

    Equal starts and ends are taken off. Few equal pairs are chained one by one. Where lines repeat, so
    that pairs would grow with the square of the lines, `a` is halved and `b` cut where the two halves
    have most in common, which rows of bits tell; memory stays in proportion to the lines."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        lo_a, hi_a, lo_b, hi_b = todo.pop()
        while lo_a < hi_a and lo_b < hi_b and a[lo_a] == b[lo_b]:
            found.append((lo_a, lo_b))
            lo_a, lo_b = lo_a + 1, lo_b + 1
        while lo_a < hi_a and lo_b < hi_b and a[hi_a - 1] == b[hi_b - 1]:
            hi_a, hi_b = hi_a - 1, hi_b - 1
            found.append((hi_a, hi_b))
        if lo_a == hi_a or lo_b == hi_b:
            continue
        ours, theirs = a[lo_a:hi_a], b[lo_b:hi_b]
        places = _places(theirs)
        if len(ours) == 1 or sum(len(places.get(x, ())) for x in ours) <= _PAIRS * (len(ours) + len(theirs)):
            found.extend((lo_a + i, lo_b + j) for i, j in _chained(ours, theirs, places))
            continue
        half = len(ours) // 2
        above = _lengths(ours[:half], theirs)
        below = _lengths(ours[half:][::-1], theirs[::-1])[::-1]
        cut = int(np.argmax(above + below))
        todo.append((lo_a, lo_a + half, lo_b, lo_b + cut))
        todo.append((lo_a + half, hi_a, lo_b + cut, hi_b))
    return sorted(found)


def place(url: str | None) -> tuple[str | None, str]:
    """Host and path, without query and fragment."""
    if url is None:
        return None, ""
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url)
    return (found[1].lower(), found[2]) if found else ("", re.split("[?#]", url)[0])


def _hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_KEYED = "page_id long, print long, host string, path string, lines array<long>, sizes array<int>, inner array<boolean>"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = [place(u) for u in batch["url"].to_pylist()]
        lines = [lines_of(h) for h in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch["page_id"],
                batch["print"],
                pa.array([h for h, _ in places], pa.string()),
                pa.array([p for _, p in places], pa.string()),
                pa.array([[_hash(t) for _, t in own] for own in lines], pa.list_(pa.int64())),
                pa.array([[len(t) for _, t in own] for own in lines], pa.list_(pa.int32())),
                pa.array([[zone == ARTICLE for zone, _ in own] for own in lines], pa.list_(pa.bool_())),
            ],
            names=["page_id", "print", "host", "path", "lines", "sizes", "inner"],
        )


def _shared_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


_DIFFERENCED = "shared_id long, shared_print long, shared array<int>, asked array<struct<place:int,line:long>>"
_ASKED = pa.list_(pa.struct([("place", pa.int32()), ("line", pa.int64())]))


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shared: places of the lines that go; asked: those inside an article that go if no other host has them."""
    for batch in batches:
        shared, asked = [], []
        for row in batch.to_pylist():
            near = [n for n in (row["before"], row["after"]) if n and n["host"] == row["host"] and n["path"] is not None]
            partner = max(near, key=lambda n: _shared_start(n["path"], row["path"]), default=None)
            frame = set(row["frame"] or ())
            framed = {i for i, x in enumerate(row["lines"]) if x in frame}
            own = sum(row["sizes"]) - sum(row["sizes"][i] for i in framed)
            gone = {i for i, _ in common(row["lines"], partner["lines"])} - framed if partner else set()
            if sum(row["sizes"][i] for i in gone) * 100 >= COPY_PCT * own:
                gone = set()
            inner = {i for i in gone if row["inner"][i]}
            shared.append(sorted(framed | gone - inner))
            asked.append([{"place": i, "line": row["lines"][i]} for i in sorted(inner)])
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["print"], pa.array(shared, pa.list_(pa.int32())), pa.array(asked, _ASKED)],
            names=["shared_id", "shared_print", "shared", "asked"],
        )


def _lines_of_hosts(laid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hosts (of, a hash) with their different pages, and their lines with the pages that have each.
    Pages with equal lines count once."""
    page = laid.select(F.xxhash64("host").alias("of"), F.array_distinct("lines").alias("lines")).distinct()
    hosts = page.groupBy(F.col("of").alias("of_host")).agg(F.count(F.lit(1)).alias("pages"))
    return hosts, page.select("of", F.explode("lines").alias("line")).groupBy("of", "line").agg(F.count(F.lit(1)).alias("n"))


def frames(laid: DataFrame) -> DataFrame:
    """of_host (its hash), of_salt, frame (hashes of its frame's lines) of every host that has a frame.
    At most twice the lines of a host's mean page can be on half of its pages."""
    hosts, lines = _lines_of_hosts(laid)
    return (
        lines.filter(F.col("n") >= FRAME_PAGES)
        .join(hosts, (F.col("of") == F.col("of_host")) & (F.col("n") * 2 >= F.col("pages")))
        .groupBy("of_host")
        .agg(F.collect_list("line").alias("frame"))
        .withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    )


def _laid(pages: DataFrame) -> DataFrame:
    """The hashed lines of all pages in the order of host and path; `part` is the task that sorted a page."""
    keyed = pages.select("page_id", "url", "html", "print").mapInArrow(_keyed, _KEYED).dropDuplicates(["page_id", "print"])
    order = ["host", "path", "page_id", "print"]
    return written(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "pages"
    )


def shared_lines(pages: DataFrame) -> DataFrame:
    """shared_id, shared_print, shared: the places of the lines that go; spared: of lines that would go,
    but that another host has too."""
    laid = _laid(pages)
    order = ["host", "path", "page_id", "print"]
    row = F.struct(*order, "lines")
    inside = Window.partitionBy("part").orderBy(*order)
    edges = laid.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    parts = Window.orderBy("part")  # one row for each task of the sort
    edges = edges.select(
        F.col("part").alias("of"), F.lag("last").over(parts).alias("earlier"), F.lead("first").over(parts).alias("later")
    )
    met = (
        laid.withColumn("before", F.lag(row).over(inside))
        .withColumn("after", F.lead(row).over(inside))
        .join(edges, F.col("part") == F.col("of"))
        .select(
            *order,
            "lines",
            "sizes",
            "inner",
            F.coalesce("before", "earlier").alias("before"),
            F.coalesce("after", "later").alias("after"),
        )
        .join(
            frames(laid),
            (F.xxhash64("host") == F.col("of_host")) & (F.pmod("print", F.lit(_SALTS)).cast("int") == F.col("of_salt")),
            "left",
        )
        .drop("of_host", "of_salt")
    )
    decided = written(met.mapInArrow(_differenced, _DIFFERENCED), "differenced")
    wide = _lines_of_hosts(laid)[1].groupBy("line").agg(F.count(F.lit(1)).alias("hosts")).filter("hosts > 1")
    asked = decided.select("shared_id", "shared_print", F.explode("asked").alias("asked"))
    spared = (
        asked.select("shared_id", "shared_print", "asked.place", "asked.line")
        .join(wide, "line", "left_semi")
        .groupBy(F.col("shared_id").alias("id"), F.col("shared_print").alias("of"))
        .agg(F.collect_list("place").alias("spared"))
    )
    both = F.col("shared_id").eqNullSafe(F.col("id")) & (F.col("shared_print") == F.col("of"))
    places = F.concat("shared", F.transform("asked", lambda x: x["place"]))
    return decided.join(spared, both, "left").select("shared_id", "shared_print", places.alias("shared"), "spared")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that can be main text, and their places among all lines of the page."""
    for batch in batches:
        places, texts = [], []
        for html in batch["html"].to_pylist():
            lines = lines_of(html)
            marked = any(zone == ARTICLE for zone, _ in lines)
            own = [(i, t) for i, (zone, t) in enumerate(lines) if zone == ARTICLE or not marked]
            places.append([i for i, _ in own])
            texts.append([t for _, t in own])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch[c] for c in ("page_id", "url", "rest", "print")),
                pa.array(places, pa.list_(pa.int32())),
                pa.array(texts, pa.list_(pa.string())),
            ],
            names=["page_id", "url", "rest", "print", "places", "texts"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        columns = (batch[c].to_pylist() for c in ("places", "texts", "shared", "spared"))
        for places, lines, shared, spared in zip(*columns, strict=True):
            gone = set(shared or ()).difference(spared or ())
            texts.append("\n".join(t for i, t in zip(places, lines, strict=True) if i not in gone))
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], batch["rest"], pa.array(texts, pa.string())],
            names=["page_id", "url", "rest", "text"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, rest (a struct of the other columns but html), text and n_chars."""
    others = [F.col(f"`{c}`") for c in pages.columns if c not in ("page_id", "url", "html")]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        rest.alias("rest"),
    )
    rows = rows.withColumn("print", F.xxhash64("page_id", "url", "html"))
    kept = [f for f in rows.schema.fields if f.name in ("page_id", "url", "rest")]
    more = T._parse_datatype_string("places array<int>, texts array<string>").fields
    own = [f for f in rows.schema.fields if f.name != "html"]
    lines = rows.mapInArrow(_candidates, T.StructType([*own, *more]))
    both = F.col("page_id").eqNullSafe(F.col("shared_id")) & (F.col("print") == F.col("shared_print"))
    joined = lines.join(shared_lines(rows), both, "left").select(
        "page_id", "url", "rest", "places", "texts", "shared", "spared"
    )
    texts = joined.mapInArrow(_texts, T.StructType([*kept, T.StructField("text", T.StringType())]))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
