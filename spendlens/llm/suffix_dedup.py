"""Repeated byte strings, by a common-prefix-aware distributed merge sort of suffixes.

A document loses every byte that lies in a `length`-byte string which also starts in a document with a
smaller doc_id. Sorting all suffixes would move every byte `length` times, so suffixes are sorted where
equal strings must have one: each string of `length` bytes has an anchor, its `anchor`-byte piece with
the least hash, and equal strings have theirs at the same place. Neighbouring strings share anchors
(one for some sixteen bytes), and an anchor owns a run of neighbouring strings.

1. Anchors whose piece occurs in two documents are found by exchanging the distinct hashes of each
   block. Other anchors own no repeated string.
2. Each block sorts the suffixes at those anchors, with the bytes to the left that its owned strings
   reach (equal ones once), and cuts the sorted run at sampled splitters. A part of a run is sent
   front-coded: what a suffix shares with the one before is sent as a length.
3. For a key range the runs are merged by a loser tree whose nodes keep how much of its prefix a loser
   shares with the last winner; only bytes beyond that are ever compared. Merged suffixes that share an
   anchor's piece lie together, and inside such a lot the owned strings are grouped (by two 64-bit
   hashes) and those of any but the smallest document are marked.

An anchor's piece that very many contexts share would make a lot of unbounded size; from `hot` contexts
on, its strings are sent one by one as suffixes of their own, which meet by their whole content, once
for each block. Splitters come from a bounded sample and steer balance only.

Defined results: a null text is empty; texts shorter than `length` lose nothing; matches never cross
documents; a null doc_id is the smallest; rows that repeat a doc_id are one document number, so they
take nothing from each other; an empty table gives an empty result; further columns travel untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .text import U64, Rolling, _LETTERS, byte_windows, column_bytes, covered, mixed

LENGTH, ANCHOR = 50, 20
HOT = 100_000
_AT_ONCE = 1 << 18  # strings that are grouped together


class _Anchors:
    def __init__(self, data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, length: int, anchor: int):
        self.data, self.docs = data, docs
        pieces = byte_windows(data, anchor)
        least = ((pieces >> U64(32)) << U64(32)) | np.arange(len(pieces), dtype=U64)
        width, have = length - anchor + 1, 1
        while have < width:  # the least of ever wider runs; the leftmost of equal ones
            step = min(have, width - have)
            least = np.minimum(least[: max(0, len(least) - step)], least[step:])
            have += step
        least = (least & U64(0xFFFFFFFF)).astype(np.int64)
        crossing = covered(len(data), np.maximum(offsets[:-1], offsets[1:] - length + 1), offsets[1:])
        starts = np.flatnonzero(~crossing[: len(least)])
        at = least[starts]
        new = np.ones(len(at), dtype=bool)
        new[1:] = at[1:] != at[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1 if len(first) else first
        #: places of the anchors, and first and last start of the strings each owns
        self.at, self.lo, self.hi = at[first], starts[first], starts[last]
        self.row = np.searchsorted(offsets, self.at, "right") - 1
        doc = docs[self.row]
        key = mixed(pieces[self.at] + U64(1))  # anchors have small hashes; ranges want even ones
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(key)) if len(begin) else begin
        self.keys, self.times = key[begin], end - begin
        self.local = doc[begin] != doc[end - 1] if len(begin) else np.zeros(0, dtype=bool)
        self.which = np.empty(len(key), dtype=np.int64)
        self.which[order] = np.cumsum(new) - 1


class _Suffixes:
    """The suffixes a block sends: sorted, equal ones once, for the smallest document."""

    def __init__(self, a: _Anchors, repeated: np.ndarray, hot: np.ndarray, splitters: np.ndarray, length: int, anchor: int):
        chosen = repeated[a.which] & ~hot[a.which]
        single = np.flatnonzero(hot[a.which] & repeated[a.which])
        counts = (a.hi - a.lo + 1)[single]
        alone = np.repeat(a.lo[single], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.concatenate([a.at[chosen], alone])
        lo = np.concatenate([a.lo[chosen], alone])
        hi = np.concatenate([a.hi[chosen], alone])
        doc = a.docs[np.concatenate([a.row[chosen], np.repeat(a.row[single], counts)])]
        n_right, n_left = hi + length - at, at - lo
        right = _cells(a.data, at, n_right, length)
        left = _cells(a.data, at - (length - anchor), n_left, length - anchor, at_end=True)
        s_right, s_left = right.view(f"S{length}").ravel(), left.view(f"S{length - anchor}").ravel()
        order = np.lexsort((doc, n_left, s_left, n_right, s_right))
        new = np.ones(len(order), dtype=bool)
        same = np.ones(max(0, len(order) - 1), dtype=bool)
        for values in (n_left, s_left, n_right, s_right):
            same &= values[order][1:] == values[order][:-1]
        new[1:] = ~same
        keep = order[new]
        self.lo, self.hi, self.order, self.group = lo, hi, order, np.cumsum(new) - 1
        self.doc = doc[order]
        self.n_right, self.n_left, self.right, self.left, self.of = n_right[keep], n_left[keep], right[keep], left[keep], doc[keep]
        self.length = length
        piece = np.ascontiguousarray(self.right[:, :anchor]).view(f"S{anchor}").ravel()
        parts = np.searchsorted(splitters, piece, "right") if len(splitters) else np.zeros(len(piece), dtype=np.int64)
        self.cuts = np.searchsorted(parts, np.arange(len(splitters) + 2))
        #: strings owned by each sent suffix, counted up
        self.owned = np.concatenate([[0], np.cumsum(self.n_left + self.n_right - length + 1)])

    def payload(self, lo: int, hi: int) -> bytes:
        n, right = hi - lo, self.right[lo:hi]
        known = np.zeros(n, dtype=np.uint8)
        if n > 1:
            differ = right[1:] != right[:-1]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), self.length)
            known[1:] = np.minimum(first, np.minimum(self.n_right[lo + 1 : hi], self.n_right[lo : hi - 1]))
        column = np.arange(self.length)
        rest = right[(column >= known[:, None]) & (column < self.n_right[lo:hi, None])]
        width = self.left.shape[1]
        left = self.left[lo:hi][np.arange(width) >= width - self.n_left[lo:hi, None]]
        return b"".join(
            (
                np.uint32(n).tobytes(),
                self.n_right[lo:hi].astype(np.uint8).tobytes(),
                self.n_left[lo:hi].astype(np.uint8).tobytes(),
                known.tobytes(),
                self.of[lo:hi].astype("<i8").tobytes(),
                rest.tobytes(),
                left.tobytes(),
            )
        )


def _cells(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int, at_end: bool = False) -> np.ndarray:
    """A row of bytes for each run, padded with zeros; `at_end` pads in front."""
    column = np.arange(width)
    real = column >= width - sizes[:, None] if at_end else column < sizes[:, None]
    places = np.where(real, starts[:, None] + column, 0)
    return np.where(real, data[places], 0).astype(np.uint8) if len(data) else np.zeros((0, width), dtype=np.uint8)


def _unpacked(payload: bytes, length: int):
    """Right parts and left parts as bytes, shared prefix lengths, documents, and how many strings each
    suffix owns, of a front-coded run."""
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    sizes = [np.frombuffer(payload, np.uint8, n, 4 + k * n) for k in range(3)]
    n_right, n_left, known = (x.tolist() for x in sizes)
    owned = sizes[0].astype(np.int64) + sizes[1] - length + 1
    docs = np.frombuffer(payload, "<i8", n, 4 + 3 * n)
    at, rights, last = 4 + 11 * n, [], b""
    for size, same in zip(n_right, known, strict=True):
        last = last[:same] + payload[at : at + size - same]
        at += size - same
        rights.append(last)
    lefts = []
    for size in n_left:
        lefts.append(payload[at : at + size])
        at += size
    return rights, lefts, known, docs, owned


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Sorted runs (strings, and what each shares with the one before) into one order.

    Gives run, place and the prefix shared with the string before. A loser's node keeps the prefix it
    shares with the string that beat it. Of two that share different amounts with the last winner the
    one that shares more is smaller, without a look; equal amounts are compared from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    loser, shared = [0] * size, [-1] * size
    strings = [s for s, _ in runs] + [[]] * (size - len(runs))
    known = [k for _, k in runs] + [[]] * (size - len(runs))
    now = [s[0] if s else b"" for s in strings]
    place, ends = [0] * size, [len(s) for s in strings]

    def better(node: int, r: int, h: int, other: int, oh: int) -> tuple[int, int]:
        """The winner of two, and the other one into the node."""
        if oh > h:
            loser[node], shared[node] = r, h
            return other, oh
        at = oh
        if oh == h and h >= 0:
            a, b = now[r], now[other]
            if a == b:
                at = len(a)
            else:
                most = min(len(a), len(b))
                while at < most and a[at : at + 8] == b[at : at + 8]:
                    at += 8
                at = min(at, most)
                while at < most and a[at] == b[at]:
                    at += 1
                if (len(b) < len(a)) if at == most else (b[at] < a[at]):
                    loser[node], shared[node] = r, at
                    return other, oh
        loser[node], shared[node] = other, at
        return r, h

    winners = [(r, 0 if ends[r] else -1) for r in range(size)]
    level = size
    while level > 1:
        level //= 2
        winners = [better(level + i, *winners[2 * i], *winners[2 * i + 1]) for i in range(level)]
    (r, h), out_run, out_place, out_shared = winners[0], [], [], []
    while h >= 0:
        out_run.append(r)
        out_place.append(place[r])
        out_shared.append(h)
        i = place[r] = place[r] + 1
        if i < ends[r]:
            now[r], h = strings[r][i], known[r][i]
        else:
            h = -1
        node = (r + size) >> 1
        while node:
            oh = shared[node]
            if oh > h:
                loser[node], shared[node], r, h = r, h, loser[node], oh
            elif oh == h and h >= 0:
                r, h = better(node, r, h, loser[node], oh)
            node >>= 1
    return out_run, out_place, out_shared


def _least(contexts: list[bytes], docs: np.ndarray, owned: np.ndarray, length: int) -> np.ndarray:
    """For all owned strings of some contexts in a row: the smallest document that has the string."""
    blob = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.cumsum([0, *(len(c) for c in contexts)])[:-1]
    starts = np.repeat(begin, owned) + np.arange(owned.sum()) - np.repeat(np.cumsum(owned) - owned, owned)
    one, two = (Rolling(_LETTERS[k][blob], k).windows(length)[starts] for k in (0, 1))
    doc = np.repeat(docs, owned)
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    least = np.empty(len(order), dtype=np.int64)
    least[order] = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    return least


def _meet_suffixes(part: int, blocks: list[int], payloads: list[bytes], length: int, anchor: int) -> pa.Table:
    runs = [_unpacked(p, length) for p in payloads]
    run, place, shared = merge([(r[0], r[2]) for r in runs])
    first = np.concatenate([[0], np.cumsum([len(r[0]) for r in runs])])
    order = first[np.array(run, dtype=np.int64)] + np.array(place, dtype=np.int64)
    rights, lefts = ([x for r in runs for x in r[k]] for k in (0, 1))
    doc, owned = (np.concatenate([r[k] for r in runs]) for k in (3, 4))
    offset = np.concatenate([[0], np.cumsum(owned)])
    out = np.zeros(offset[-1], dtype=bool)
    # lots of suffixes that share a piece; those of one document take nothing from each other
    begin = np.flatnonzero(np.array(shared) < anchor)
    lot = np.minimum.reduceat(doc[order], begin), np.maximum.reduceat(doc[order], begin)
    sizes = np.diff(np.append(begin, len(order)))
    order = order[np.repeat(lot[0] != lot[1], sizes)]
    sizes = sizes[lot[0] != lot[1]]
    # whole lots at once, as many as hold some number of strings
    strings = np.cumsum(np.add.reduceat(owned[order], np.cumsum(sizes) - sizes)) if len(sizes) else sizes
    groups = np.split(order, np.cumsum(sizes)[np.flatnonzero(np.diff(strings // _AT_ONCE))])
    for group in groups:
        known: dict[bytes, int] = {}
        which = np.array(
            [known.setdefault(bytes((len(lefts[i]),)) + lefts[i] + rights[i], len(known)) for i in group.tolist()], dtype=np.int64
        )
        if not len(which):
            continue
        smallest = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(smallest, which, doc[group])
        own = np.zeros(len(known), dtype=np.int64)
        own[which] = owned[group]
        least = _least([c[1:] for c in known], smallest, own, length)
        n = owned[group]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        base = (np.cumsum(own) - own)[which]
        out[np.repeat(offset[group], n) + within] = np.repeat(doc[group], n) > least[np.repeat(base, n) + within]
    return B.answered(2, part, blocks, np.split(out, offset[first[1:-1]]))


def _meet_pieces(part: int, blocks: list[int], payloads: list[bytes], hot: int) -> pa.Table:
    sizes = [len(p) // 10 for p in payloads]
    keys = np.concatenate([np.frombuffer(p, "<u8", n) for p, n in zip(payloads, sizes, strict=True)])
    times = np.concatenate([np.frombuffer(p, "<u2", n, 8 * n) for p, n in zip(payloads, sizes, strict=True)])
    unique, which, blocks_of = np.unique(keys, return_inverse=True, return_counts=True)
    again = (blocks_of > 1)[which]
    many = (np.bincount(which, times, len(unique)) >= hot)[which]
    ends = np.cumsum(sizes)[:-1]
    answers = B.answered(1, part, blocks, np.split(again, ends))
    return pa.concat_tables([answers, B.answered(3, part, blocks, np.split(many, ends))]) if many.any() else answers


class _Steps:
    """The three steps of a block; each builds the same arrays from the same texts."""

    def __init__(self, parts: int, splitters: np.ndarray, length: int, anchor: int):
        self.parts, self.splitters, self.length, self.anchor = parts, splitters, length, anchor

    def anchors(self, table: pa.Table) -> tuple[_Anchors, np.ndarray, np.ndarray]:
        ids, data, offsets = B.contents(table)
        return _Anchors(data, offsets, ids, self.length, self.anchor), data, offsets

    def first(self, key, table: pa.Table) -> pa.Table:
        a, _, _ = self.anchors(B.ordered(table))
        times = np.minimum(a.times, 0xFFFF).astype("<u2")
        return B.sent(
            key[0].as_py(), B.shares(a.keys, self.parts), lambda lo, hi: a.keys[lo:hi].tobytes() + times[lo:hi].tobytes()
        )

    def suffixes(self, a: _Anchors, answers: pa.Table) -> _Suffixes:
        cuts = B.shares(a.keys, self.parts)
        repeated = a.local | B.marks(answers, 1, cuts)
        return _Suffixes(a, repeated, B.marks(answers, 3, cuts), self.splitters, self.length, self.anchor)

    def second(self, key, table: pa.Table, answers: pa.Table) -> pa.Table:
        a, _, _ = self.anchors(B.ordered(table))
        s = self.suffixes(a, answers)
        return B.sent(key[0].as_py(), s.cuts, s.payload)

    def finish(self, key, table: pa.Table, answers: pa.Table) -> pa.Table:
        table = B.ordered(table)
        a, data, offsets = self.anchors(table)
        s = self.suffixes(a, answers)
        sent = B.marks(answers, 2, s.owned[s.cuts])
        # of equal contexts in the block the first, of the smallest document, was asked for; the
        # strings of greater documents go, those of the same document go as the answer says
        lo, n = s.lo[s.order], (s.hi - s.lo + 1)[s.order]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gone = sent[np.repeat(s.owned[:-1][s.group], n) + within] | np.repeat(s.doc > s.of[s.group], n)
        starts = (np.repeat(lo, n) + within)[gone]
        out = covered(len(data), starts, starts + self.length)
        return _rows(table, data, offsets, out)


def _rows(table: pa.Table, data: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> pa.Table:
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    before[1:], after[:-1] = out[:-1], out[1:]
    begin = np.flatnonzero(out & (~before | edge[:-1]))
    end = np.flatnonzero(out & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, begin, "right") - 1
    first = np.searchsorted(row, np.arange(len(offsets)))
    spans = pa.ListArray.from_arrays(
        pa.array(first, pa.int32()),
        pa.StructArray.from_arrays([pa.array(begin - offsets[row]), pa.array(end - offsets[row])], ["start", "end"]),
    )
    removed = np.diff(np.concatenate([[0], np.cumsum(out)])[offsets])
    kept_ends = np.concatenate([[0], np.cumsum(~out)])[offsets].astype(np.int32)
    kept = pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(kept_ends.tobytes()), pa.py_buffer(data[~out].tobytes())]
    )
    return pa.table(
        {
            "doc_id": table["doc_id"],
            "text": table["text"],
            "rest": table["rest"],
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": spans,
            "kept": kept,
        }
    )


def _splitters(docs: DataFrame, parts: int, length: int, anchor: int) -> np.ndarray:
    """Pieces that cut the order into parts of like size, from a bounded sample of texts."""
    texts = B.sampled_texts(docs)
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    at = _Anchors(data, offsets, np.arange(len(texts)), length, anchor).at
    pieces = np.sort(_cells(data, at, np.full(len(at), anchor), anchor).view(f"S{anchor}").ravel())
    return np.unique(pieces[np.arange(1, parts) * len(pieces) // parts]) if len(pieces) else pieces


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block_bytes: int = B.BLOCK_BYTES, hot: int = HOT
) -> DataFrame:
    """doc_id, text, rest (a struct of the other columns), n_bytes, n_removed, spans (removed byte
    runs) and kept (the remaining bytes, which may cut a character)."""
    return _found(docs, B.deal(docs, block_bytes), length, anchor, hot)


def _found(docs: DataFrame, dealt: B.Dealt, length: int, anchor: int, hot: int) -> DataFrame:
    if not 8 <= anchor < length <= 255:
        raise ValueError("8 <= anchor < length <= 255")
    steps = _Steps(dealt.parts, _splitters(docs, dealt.parts, length, anchor), length, anchor)

    def part(meet, *more):
        return lambda key, t: meet(key[0].as_py(), t["block"].to_pylist(), t["payload"].to_pylist(), *more)

    return B.two_rounds(
        dealt,
        lambda key, t: steps.first(key, t),
        part(_meet_pieces, hot),
        lambda key, t, answers: steps.second(key, t, answers),
        part(_meet_suffixes, length, anchor),
        lambda key, t, answers: steps.finish(key, t, answers),
        B.with_columns(dealt, "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"),
    )


def digest(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    dealt = B.deal(docs)
    rows = _found(docs, dealt, LENGTH, ANCHOR, HOT).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    return dealt.few_files(rows)
