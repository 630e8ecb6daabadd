"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the benchmark's items.

Texts are normalised byte by byte (A-Z in lower case, every ASCII byte that is no letter or digit is
a separator), so a place in the normalised text is a place in the original. A window is `window`
consecutive words of an item, or all its words if it has fewer. The automaton holds the windows as
words with one blank before, between and after; a document is scanned once, and words inside any
occurrence are hit.

The items are sent to every task, so their size is bounded: beyond `lot_bytes` of text they are split
into lots by a hash of item_id, each with an automaton of its own, and what the lots find is united.

Defined results: null, empty and wordless documents have no words and no hits; null, empty and
wordless items have no window; rows that repeat an item_id are one item; a null item_id is the empty
string; rows that repeat a doc_id are scanned one by one; empty tables give empty results or no hits;
further columns travel untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 10
#: Text of the items of one automaton; its trie has some seventy nodes for each of their words.
LOT_BYTES = 512 << 10

#: Letters, digits and all bytes of other scripts are parts of words.
_IN_WORD = frozenset([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_NORMAL = bytes(b if b in _IN_WORD else 0x20 for b in range(256)).lower()

FOUND = "n_words long, hits array<struct<first:long,last:long>>, spans array<struct<start:long,end:long>>, items array<string>"


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def _windows(words: list[bytes], window: int) -> list[bytes]:
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))] if words else []


class Scanner:
    """An automaton over (item id, text) rows, built where it is used."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        holders: dict[bytes, set[str]] = {}
        for item, text in items:
            for w in _windows(normal_words(text), window):
                holders.setdefault(w, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for w, ids in holders.items():
            self.automaton.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, len(w) + 2, tuple(ids)))
        self.empty = not holders
        if holders:
            self.automaton.make_automaton()

    def scan(self, text: str | None):
        """Words of a text, hit word runs, their code point spans in the original, and items."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.translate(_NORMAL).split()
        if self.empty or not words:
            return len(words), [], [], []
        line = f" {b' '.join(words).decode('latin-1')} "
        found = [(end - length + 1, n, ids) for end, (n, length, ids) in self.automaton.iter(line)]
        if not found:
            return len(words), [], [], []
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
        first = np.searchsorted(blanks, [at for at, _, _ in found])
        hits = _united(zip(first.tolist(), (first + [n for _, n, _ in found]).tolist(), strict=True))
        return len(words), hits, _spans(raw, hits), sorted({i for _, _, ids in found for i in ids})


def _united(runs) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _spans(raw: bytes, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    inside = np.frombuffer(raw.translate(_NORMAL), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in hits]


def _rows(results) -> list[pa.Array]:
    run = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return [
        pa.array([r[0] for r in results], pa.int64()),
        pa.array([[{"first": a, "last": b - 1} for a, b in r[1]] for r in results], run),
        pa.array([[{"start": a, "end": b} for a, b in r[2]] for r in results], span),
        pa.array([r[3] for r in results], pa.list_(pa.string())),
    ]


def _scan_all(items, window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(items.value, window)
        for batch in batches:
            results = [scanner.scan(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *_rows(results)],
                names=[*batch.schema.names, "n_words", "hits", "spans", "items"],
            )

    return scan


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        results = []
        for row in batch.to_pylist():
            hits = _united((h["first"], h["last"] + 1) for lot in row["hits"] for h in lot)
            raw = (row["text"] or "").encode("utf-8", "surrogatepass")
            items = sorted({i for lot in row["items"] for i in lot})
            results.append((row["n_words"], hits, _spans(raw, hits), items))
        kept = [batch[c] for c in ("doc_id", "text", "rest")]
        yield pa.RecordBatch.from_arrays(
            [*kept, *_rows(results)], names=["doc_id", "text", "rest", "n_words", "hits", "spans", "items"]
        )


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """doc_id, text, rest (a struct of the other columns), n_words, hits (runs of hit words), spans
    (the same in code points of the text), items (ids of the items with an occurring window)."""
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), rest.alias("rest"))
    schema = T.StructType(texts.schema.fields + T._parse_datatype_string(FOUND).fields)
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lots = max(1, math.ceil(total / lot_bytes))

    def found(lot: int) -> DataFrame:
        own = items.filter(F.pmod(F.xxhash64("item"), F.lit(lots)) == lot).collect()
        sent = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in own])
        return texts.mapInArrow(_scan_all(sent, window), schema)

    if lots == 1:
        return found(0)
    parts = [
        found(lot).select("doc_id", F.xxhash64("text").alias("print"), "n_words", "hits", "items") for lot in range(lots)
    ]
    united = (
        reduce(DataFrame.union, parts)
        .groupBy("doc_id", "print")
        .agg(F.max("n_words").alias("n_words"), F.collect_list("hits").alias("hits"), F.collect_list("items").alias("items"))
        .select(F.col("doc_id").alias("id"), F.col("print").alias("of"), "n_words", "hits", "items")
    )
    # xxhash64 skips a null, so a null text has the print of nothing on both sides
    both = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("of"))
    joined = texts.join(united, both).select("doc_id", "text", "rest", "n_words", "hits", "items")
    return joined.mapInArrow(_unite, schema)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["last"] - h["first"] + 1)
    return scan(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a hit, with their columns."""
    own = [F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns]
    return scan(docs, benchmark).filter(F.size("hits") == 0).select(*own)
