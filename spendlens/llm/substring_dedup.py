"""Repeated word windows, found by difference-cover anchors.

A window is `window` consecutive words of one document. Words at positions whose residue modulo the
period lies in the cover start an anchor of `window - period + 1` words. For any two positions some
shift below the period puts both on the cover, so two equal windows hold an equal anchor at the same
shift; windows without a repeated anchor need no look. Windows around repeated anchors are compared
whole, by two independent 64-bit hashes.

Defined results: a null or wordless text has no words and stays without; documents shorter than a
window lose nothing; of equal windows only the earliest (smaller doc_id, null first, then earlier
start) stays; rows that repeat a doc_id count as separate documents in the order of their texts; an
empty table gives an empty result; further columns travel untouched.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .text import U64, Rolling, Words, covered

WINDOW = 20
#: {0, 1, 3, 9} is a perfect difference set: its differences give every residue modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)
_ENTRY = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc", "<i8")])


class _Anchors:
    def __init__(self, words: Words, window: int, parts: int):
        width = window - PERIOD + 1
        self.words, self.hashes = words, words.hashes()
        place = np.arange(len(words)) - words.first[:-1][words.owner]
        on = np.zeros(PERIOD, dtype=bool)
        on[list(COVER)] = True
        size = words.counts[words.owner]
        self.at = np.flatnonzero(on[place % PERIOD] & (place + width <= size) & (size >= window))
        keys = Rolling(self.hashes).windows(width)[self.at] if len(self.at) else np.zeros(0, U64)
        self.keys, self.which, self.times = np.unique(keys, return_inverse=True, return_counts=True)
        self.cuts = B.shares(self.keys, parts)

    def candidates(self, window: int, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a repeated anchor."""
        hit = self.at[(repeated | (self.times > 1))[self.which]]
        owner = self.words.owner[hit]
        first, last = self.words.first[:-1][owner], self.words.first[1:][owner] - window
        starts, ends = np.maximum(hit - PERIOD + 1, first), np.minimum(hit, last) + 1
        real = ends > starts
        return np.flatnonzero(covered(len(self.words), starts[real], ends[real]))


class _Windows:
    """Candidate windows; of equal ones in a block only the earliest is sent."""

    def __init__(self, anchors: _Anchors, window: int, repeated: np.ndarray, parts: int):
        words = anchors.words
        self.at = anchors.candidates(window, repeated)
        one, two = (
            Rolling(h, k).windows(window)[self.at] if len(self.at) else np.zeros(0, U64)
            for k, h in enumerate((anchors.hashes, words.hashes(1) if len(self.at) else np.zeros(0, U64)))
        )
        order = np.lexsort((self.at, two, one))
        one, two = one[order], two[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.order, self.new = order, new
        self.one, self.two = one[new], two[new]
        self.doc = words.owner[self.at[order[new]]]
        self.cuts = B.shares(self.one, parts)


def _first(window: int, parts: int, key, table: pa.Table) -> pa.Table:
    _, data, offsets = B.contents(B.ordered(table))
    a = _Anchors(Words(data, offsets), window, parts)
    return B.sent(key[0].as_py(), a.cuts, lambda lo, hi: a.keys[lo:hi].tobytes())


def _meet_first(key, table: pa.Table) -> pa.Table:
    lots = [np.frombuffer(p, "<u8") for p in table["payload"].to_pylist()]
    keys = np.concatenate(lots)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    ends = np.cumsum([len(x) for x in lots])[:-1]
    return B.answered(1, key[0].as_py(), table["block"].to_pylist(), np.split(again, ends))


def _second(window: int, parts: int, key, table: pa.Table, answers: pa.Table) -> pa.Table:
    ids, data, offsets = B.contents(B.ordered(table))
    a = _Anchors(Words(data, offsets), window, parts)
    w = _Windows(a, window, B.marks(answers, 1, a.cuts), parts)
    out = np.empty(len(w.one), dtype=_ENTRY)
    out["one"], out["two"], out["doc"] = w.one, w.two, ids[w.doc]
    block = key[0].as_py() if key[0].as_py() is not None else 0
    return B.sent(block, w.cuts, lambda lo, hi: out[lo:hi].tobytes())


def _meet_second(key, table: pa.Table) -> pa.Table:
    lots = [np.frombuffer(p, _ENTRY) for p in table["payload"].to_pylist()]
    all_of = np.concatenate(lots)
    order = np.lexsort((all_of["doc"], all_of["two"], all_of["one"]))
    one, two = all_of["one"][order], all_of["two"][order]
    later = np.zeros(len(order), dtype=bool)
    later[order[1:]] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
    ends = np.cumsum([len(x) for x in lots])[:-1]
    return B.answered(2, key[0].as_py(), table["block"].to_pylist(), np.split(later, ends))


def _finish(window: int, parts: int, key, table: pa.Table, answers: pa.Table) -> pa.Table:
    table = B.ordered(table)
    _, data, offsets = B.contents(table)
    words = Words(data, offsets)
    a = _Anchors(words, window, parts)
    w = _Windows(a, window, B.marks(answers, 1, a.cuts), parts)
    gone = ~w.new
    gone[np.flatnonzero(w.new)] = B.marks(answers, 2, w.cuts)
    starts = w.at[w.order[gone]]
    out = covered(len(words), starts, starts + window)
    removed = np.diff(np.concatenate([[0], np.cumsum(out)])[words.first])
    raw, texts = data.tobytes(), []
    for d, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        own = raw[lo:hi].split()
        if removed[d]:
            own = compress(own, ~out[words.first[d] : words.first[d + 1]])
        texts.append(b" ".join(own))
    return pa.table(
        {
            "doc_id": table["doc_id"],
            "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "rest": table["rest"],
            "n_words": pa.array(words.counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """The columns of `docs`, the text as its kept words joined by one blank, n_words and n_removed.

    Two sent arrays make the traffic: the distinct anchors of a block (4 of 13 words start one) and,
    around anchors that occur again, the distinct windows. Nothing is collected.
    """
    dealt = B.deal(docs, block_bytes)
    return B.unpacked(_found(dealt, window), docs, "n_words", "n_removed")


def _found(dealt: B.Dealt, window: int) -> DataFrame:
    if window < PERIOD:
        raise ValueError(f"a window must have {PERIOD} words or more")
    n = dealt.parts
    return B.two_rounds(
        dealt,
        lambda key, t: _first(window, n, key, t),
        lambda key, t: _meet_first(key, t),
        lambda key, t, answers: _second(window, n, key, t, answers),
        lambda key, t: _meet_second(key, t),
        lambda key, t, answers: _finish(window, n, key, t, answers),
        B.with_columns(dealt, "n_words long, n_removed long"),
    )


def digest(docs: DataFrame) -> DataFrame:
    dealt = B.deal(docs.select("doc_id", "text"))
    kept = F.sha2(F.col("text"), 256).alias("kept_sha256")
    return dealt.few_files(_found(dealt, WINDOW).select("doc_id", "n_words", "n_removed", kept))
