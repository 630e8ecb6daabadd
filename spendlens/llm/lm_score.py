"""Scores of whole texts: an add-one word model as base, and a context mixing model of bytes.

Texts are taken as UTF-8 with A-Z in lower case. The model predicts every byte bit by bit. Several
predictors each know a hashed context (the last two, three or four bytes, and all bytes of the
word so far) and give the log odds of the next bit; a gated set of weights, chosen by how well the
word's start is known and by the bit's place, combines them by a logistic function; a last stage maps
the mixed odds to what was seen when such odds were given. A unit is a word's bytes and one blank after
it, cut after `WIDTH` bytes, so no unit begins another one. The last bytes see over blanks and units, back
to the text's start. A text's probability (given its length) is the product of its units': the first
`REACH` bytes of a unit are scored where it occurs, once for each distinct (bytes before, byte) of a block;
its other bytes depend on nothing before it, so they are scored once for each distinct unit.

The bits have the share of the units that the counts do not know; the other share is the unit's
relative frequency in the training documents. So the predictors count every distinct unit once,
however frequent, and the weights learn from units that the predictors have not counted, each with the bytes
before it. Contexts that reach over a unit's start count each occurrence. Last, where a
text's last two units occurred in it before, the unit that followed them then is expected: the share
it gets is gated by how many such guesses were right in a row, and so adapts with the text.

Learning: documents with crc32(doc_id as text) mod 7 other than 2 are the training documents; 2 is held
out. Unit counts of the training documents but those with remainder 6 make the predictors; those with
remainder 6 make the weights and the last stage, by online logistic regression in small batches, in a
few rounds whose results are averaged over the tasks.

What travels: each block sends its distinct units, cut into key ranges, with their counts; each task the
distinct contexts over units' starts, with theirs.
Ranges add up exact counts of all training units, whatever their number, and answer with each word's
count and each unit's score. The predictors' tables have a fixed size (`SLOTS` a predictor), whatever
the corpus; only they, some hundred weights and a few totals pass through the driver. A slot keeps the
context that was counted most; a context that is not in its slot gives no opinion.

Defined results: a null or empty text has one token (its end) and model score 0; a null doc_id counts
as empty text in crc32; rows that repeat a doc_id are documents of their own; an empty table gives an
empty result; without training documents all counts are 0; further columns travel untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .components import written
from .text import _LETTERS, SPACES, U64, Rolling, Words, column_bytes, cut, mixed, numbers

FOLDS, HELD_OUT, FOR_WEIGHTS = 7, 2, 6
WIDTH = 24  # bytes of a unit; longer runs go on in further units
ORDERS = (2, 3, 4)
REACH = max(ORDERS)  # bytes before a unit that its first bytes see
PREDICTORS = len(ORDERS) + 1  # and the word so far
SEGMENTS = 256
SLOTS = (1 << 18, 1 << 20, 1 << 20, 1 << 22)  # of each predictor
LEVELS = 4  # how well the word so far is known: not, under 8 times, under 64 times, more
BUCKETS = 33  # of the last stage
GUESSES = 16  # gates of the guesses inside a text
ROUNDS, LOT = 3, 4096
RATE, MEMORY, FIRM = 0.2, 0.9, 50.0  # step, what a lot's curvature keeps for the next, and its start
LEAST_SEEN = 2  # contexts seen less often in all ranges together are not kept
OVER_UNITS, HELD_EVENTS = -3, 1 << 20  # block number of counted contexts over units' starts, and how many are held
_SEGMENT = tuple(n // SEGMENTS for n in SLOTS)

_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_NODE = [(mixed(np.arange(256, dtype=U64) + U64(5)) & U64(n - 1)).astype(np.int64) for n in _SEGMENT]


# ---- units -------------------------------------------------------------------------------------


class _Units:
    """The units of lowered texts in their order, and the distinct ones."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:] = _ENDS[data]  # a blank ends a unit
        begins[offsets[:-1]] = True
        heads = np.flatnonzero(begins[:-1])
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.concatenate([[0], np.cumsum(begins[:-1])])[offsets]))
        ends = np.append(heads[1:], len(data)) if len(heads) else heads
        at = np.minimum(np.searchsorted(words.starts, heads), max(0, len(words) - 1))
        is_word = words.starts[at] == heads if len(words) else np.zeros(len(heads), dtype=bool)
        size = np.where(is_word, words.ends[at] - heads, 0) if len(words) else np.zeros(len(heads), dtype=np.int64)
        tail = np.zeros(len(heads), dtype=U64)
        for i in np.flatnonzero(size > WIDTH):
            word = data[heads[i] : heads[i] + size[i]].tobytes()
            tail[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        pieces = -(-(ends - heads) // WIDTH)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(heads, pieces) + WIDTH * within
        sizes = np.minimum(WIDTH, np.repeat(ends, pieces) - starts)
        word = np.where(within == 0, np.repeat(np.minimum(size, WIDTH), pieces), 0)
        tail = np.where(within == 0, np.repeat(tail, pieces), U64(0))
        self.row = np.repeat(row, pieces)
        self._places = data, offsets, starts
        key = Rolling(_LETTERS[0][data]).runs(starts, starts + sizes)
        key = mixed(key + word.astype(U64)) ^ mixed(tail)
        _, first, self.which = np.unique(key, return_index=True, return_inverse=True)
        #: of the distinct units: bytes in rows, sizes, bytes of a word that begins them (0: none does),
        #: and the hash of a word that is longer than a unit
        self.size, self.word, self.tail = sizes[first], word[first], tail[first]
        column = np.arange(WIDTH)
        places = np.minimum(starts[first][:, None] + column, max(0, len(data) - 1))
        self.cells = np.where(column < self.size[:, None], data[places] if len(data) else 0, 0).astype(np.uint8)

    def before(self) -> np.ndarray:
        """Of every unit the bytes of its text before it, the last one lowest, and above them how many."""
        data, offsets, starts = self._places
        reach = np.minimum(REACH, starts - offsets[self.row])
        near = np.zeros(len(starts), dtype=np.uint32)
        for back in range(REACH, 0, -1):
            near = (near << np.uint32(8)) | data[np.maximum(starts - back, 0)]
        few = reach < REACH
        near[few] &= ((1 << 8 * reach[few]) - 1).astype(np.uint32)
        return (reach.astype(U64) << U64(32)) | near

    def times(self, chosen: np.ndarray) -> np.ndarray:
        """How often each distinct unit occurs in the chosen texts."""
        return np.bincount(self.which, chosen[self.row], len(self.size)).astype(np.int64)


def _strings(cells: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(cells).view(f"S{cells.shape[1]}").ravel() if len(cells) else np.zeros(0, f"S{cells.shape[1]}")


def _word_strings(cells: np.ndarray, word: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What decides a unit's range: its word, so that all units of a word meet."""
    return _strings(np.where(np.arange(WIDTH) < np.where(word > 0, word, size)[:, None], cells, 0))


def _laid_out(u: _Units, keep: np.ndarray, splitters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept units by range, and where each range begins."""
    strings = _word_strings(u.cells[keep], u.word[keep], u.size[keep])
    parts = np.searchsorted(splitters, strings, "right")
    order = np.argsort(parts, kind="stable")  # inside a range in the order of their hashes
    return keep[order], np.searchsorted(parts[order], np.arange(len(splitters) + 2))


def _packed(u: _Units, chosen: np.ndarray, counts: list[np.ndarray]) -> bytes:
    cells, size = u.cells[chosen], u.size[chosen]
    return b"".join(
        (
            np.uint32(len(chosen)).tobytes(),
            size.astype(np.uint8).tobytes(),
            u.word[chosen].astype(np.uint8).tobytes(),
            u.tail[chosen].astype("<u8").tobytes(),
            *(c[chosen].astype("<u4").tobytes() for c in counts),
            cells[np.arange(WIDTH) < size[:, None]].tobytes(),
        )
    )


def _unpacked(payload: bytes, n_counts: int):
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    size, word = (np.frombuffer(payload, np.uint8, n, 4 + k * n).astype(np.int64) for k in (0, 1))
    tail = np.frombuffer(payload, "<u8", n, 4 + 2 * n)
    at = 4 + 10 * n
    counts = [np.frombuffer(payload, "<u4", n, at + 4 * k * n).astype(np.int64) for k in range(n_counts)]
    blob = np.frombuffer(payload, np.uint8, -1, at + 4 * n_counts * n)
    cells = np.zeros((n, WIDTH), dtype=np.uint8)
    cells[np.arange(WIDTH) < size[:, None]] = blob
    return cells, size, word, tail, counts


def _joined(payloads: list[bytes], n_counts: int):
    """The entries of all payloads, one after the other."""
    lots = [_unpacked(p, n_counts) for p in payloads or [np.uint32(0).tobytes()]]
    return *(np.concatenate([x[k] for x in lots]) for k in range(4)), [np.concatenate([x[4][k] for x in lots]) for k in range(n_counts)]


def _unit_keys(cells: np.ndarray, size: np.ndarray, word: np.ndarray, tail: np.ndarray) -> np.ndarray:
    return _content(cells, size) ^ mixed(tail + word.astype(U64))


class _Met:
    """The units of one range from all blocks, equal ones as one, with their counts added up."""

    def __init__(self, payloads: list[bytes], n_counts: int):
        lots = [_unpacked(p, n_counts) for p in payloads]
        self.ends = np.cumsum([len(x[1]) for x in lots])[:-1]
        cells, size, word, tail = (np.concatenate([x[k] for x in lots]) for k in range(4))
        key = _unit_keys(cells, size, word, tail)
        _, first, self.which = np.unique(key, return_index=True, return_inverse=True)
        self.cells, self.size, self.word, self.tail = cells[first], size[first], word[first], tail[first]
        self.counts = [
            np.bincount(self.which, np.concatenate([x[4][k] for x in lots]), len(first)).astype(np.int64)
            for k in range(n_counts)
        ]

    def words(self) -> np.ndarray:
        """A number for the word of every unit; units without one share the last number."""
        inside = np.arange(WIDTH) < self.word[:, None]
        key = _content(np.where(inside, self.cells, 0), self.word) ^ mixed(self.tail)
        _, which = np.unique(key, return_inverse=True)
        return which


def _content(cells: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the bytes in rows."""
    key = mixed(size.astype(U64))
    for j in range(0, cells.shape[1], 8):
        key = mixed(key ^ np.ascontiguousarray(cells[:, j : j + 8]).view("<u8").ravel())
    return key


def _repeats(which: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every unit of some texts in a row: whether the two before it occurred in the text before,
    whether what followed them then is right, and how many such guesses in a row were right so far."""
    n = len(which)
    key, context = mixed(which.astype(U64) + U64(1)), np.zeros(n, dtype=U64)
    context[2:] = mixed(key[1:-1] * U64(31) + key[:-2])
    inside = np.zeros(n, dtype=bool)
    inside[2:] = row[2:] == row[:-2]
    at = np.flatnonzero(inside)
    at = at[np.argsort(mixed(context[at] ^ mixed(row[at].astype(U64))), kind="stable")]
    seen = np.full(n, -1)
    again = (context[at][1:] == context[at][:-1]) & (row[at][1:] == row[at][:-1])
    seen[at[1:][again]] = at[:-1][again]
    tried = seen >= 0
    right = tried & (which[seen] == which)
    run = np.arange(n) - np.maximum.accumulate(np.where(right, 0, np.arange(n))) if n else seen
    return tried, right, np.minimum(np.concatenate([[0], run[:-1]])[:n], GUESSES - 1)


# ---- predictors --------------------------------------------------------------------------------


_KEY_BITS = 8 + 8 * 4 + 3  # a byte, four before it, and how many of these there are


def _first_bytes(u: _Units, before: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the first `REACH` places the chosen units that have it: the byte lowest, above it what is
    before it, as of a unit that begins there."""
    which, before = u.which[chosen], before[chosen]
    size, head = u.size[which], np.ascontiguousarray(u.cells[:, :REACH]).view("<u4").ravel()[which]
    for j in range(REACH):
        some = size > j
        if not some.all():
            size, head, before = size[some], head[some], before[some]
        byte = ((head >> np.uint32(8 * j)) & np.uint32(255)).astype(U64)
        yield j, (before << U64(8)) | byte
        reach = np.minimum(U64(REACH), (before >> U64(32)) + U64(1))
        before = (reach << U64(32)) | ((before << U64(8)) & U64(0xFFFFFFFF)) | byte


def _last_bytes(order: int, j: int, cells: np.ndarray | None, before: np.ndarray) -> np.ndarray:
    """The context of the last bytes at a place of units; fewer where the text has no more."""
    reach = np.minimum(U64(order), (before >> U64(32)) + U64(j))
    key = reach | U64(order << 8)
    for back in range(1, min(j, order) + 1):
        key = (key << U64(8)) | cells[:, j - back].astype(U64)
    for back in range(j + 1, order + 1):
        byte = (before >> U64(8 * (back - j - 1))) & U64(255)
        key = np.where(reach >= back, (key << U64(8)) | byte, key)
    return key


def _contexts(
    cells: np.ndarray, size: np.ndarray, before: np.ndarray | None = None, first: int = 0, last: int = WIDTH
) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For every place in a unit from the first to before the last: the rows that have it, their byte there,
    and each predictor's context. Without what is `before` them, units begin a text."""
    word = np.full(len(size), 7, dtype=U64)
    before = np.zeros(len(size), dtype=U64) if before is None else before
    for j in range(min(last, int(size.max(initial=0)))):
        rows = np.flatnonzero(size > j)
        byte = cells[rows, j]
        if j >= first:
            near, here = cells[rows, :j], before[rows]
            contexts = [mixed(_last_bytes(order, j, near, here)) for order in ORDERS]
            yield rows, byte.astype(np.int64), [*contexts, word[rows]]
        word[rows] = mixed(word[rows] * U64(31) + byte.astype(U64))


def _where(k: int, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, place in it before the node is known, and the check that tells contexts apart."""
    segment = (context >> U64(56)).astype(np.int64)
    return segment, (context & U64(_SEGMENT[k] - 1)).astype(np.int64), ((context >> U64(40)) & U64(63)).astype(np.uint8)


_EVENT = np.dtype([("context", "<u8"), ("byte", "u1"), ("n", "<u8")])


def _added_up(context: np.ndarray, byte: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Events in the order of context and byte, equal ones as one."""
    order = np.lexsort((byte, context))
    context, byte, n = context[order], byte[order], n[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (context[1:] != context[:-1]) | (byte[1:] != byte[:-1])
    begin = np.flatnonzero(new)
    out = np.empty(len(begin), dtype=_EVENT)
    out["context"], out["byte"], out["n"] = context[begin], byte[begin], np.add.reduceat(n, begin) if len(n) else n
    return out


def _by_segment(k: int, events: np.ndarray) -> Iterator[tuple[int, bytes]]:
    cuts = np.searchsorted((events["context"] >> U64(56)).astype(np.int64), np.arange(SEGMENTS + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        yield k * SEGMENTS + int(s), events[cuts[s] : cuts[s + 1]].tobytes()


class _OverUnits:
    """Counted (context, next byte) pairs whose context begins before the byte's unit, of the chosen units.
    Equal ones meet before they are sent; so many are held at once, however long the input is."""

    def __init__(self, parts: int):
        self.parts = parts
        self.held: list[list[np.ndarray]] = [[] for _ in ORDERS]

    def add(self, u: _Units, before: np.ndarray, chosen: np.ndarray) -> None:
        chosen = chosen[before[chosen] > 0]
        for j, key in _first_bytes(u, before, chosen):
            key, n = np.unique(key, return_counts=True)
            byte = (key & U64(255)).astype(np.uint8)
            for k, order in enumerate(ORDERS):
                if j < order:
                    own = np.empty(len(key), dtype=_EVENT)
                    own["context"], own["byte"], own["n"] = mixed(_last_bytes(order, 0, None, key >> U64(8))), byte, n
                    self.held[k].append(own)

    def full(self) -> bool:
        if sum(len(x) for own in self.held for x in own) < 2 * HELD_EVENTS:
            return False
        self._fold()
        return sum(len(own[0]) for own in self.held) >= HELD_EVENTS

    def _fold(self) -> None:
        whole = [np.concatenate([np.zeros(0, dtype=_EVENT), *own]) for own in self.held]
        self.held = [[_added_up(x["context"], x["byte"], x["n"])] for x in whole]

    def send(self) -> pa.Table:
        self._fold()
        rows = [row for k, (own,) in enumerate(self.held) for row in _by_segment(k, own)]
        self.held = [[] for _ in ORDERS]
        segments = [s for s, _ in rows]
        of = np.array(segments, dtype=np.int64) * self.parts // (PREDICTORS * SEGMENTS)
        cuts = np.searchsorted(of, np.arange(self.parts + 1))

        def payload(a: int, b: int) -> bytes:
            sizes = np.array([[s, len(x)] for s, x in rows[a:b]], dtype="<u4")
            return np.uint32(b - a).tobytes() + sizes.tobytes() + b"".join(x for _, x in rows[a:b])

        return B.sent(OVER_UNITS, cuts, payload)

    @staticmethod
    def met(payloads: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """The segments of one range from all tasks, with their counts added up."""
        lots: dict[int, list[bytes]] = {}
        for payload in payloads:
            n = int(np.frombuffer(payload, "<u4", 1)[0])
            at = 4 + 8 * n
            for s, length in np.frombuffer(payload, "<u4", 2 * n, 4).reshape(n, 2).tolist():
                lots.setdefault(s, []).append(payload[at : at + length])
                at += length
        for s, own in sorted(lots.items()):
            events = np.frombuffer(b"".join(own), _EVENT)
            yield s, _added_up(events["context"], events["byte"], events["n"]).tobytes()


def _events(met: _Met, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Counted (context, next byte) pairs of the units, by predictor and segment."""
    rows = np.flatnonzero(counts > 0)
    cells, size, counts = met.cells[rows], met.size[rows], counts[rows]
    lots: list[list] = [[] for _ in range(PREDICTORS)]
    for at, byte, contexts in _contexts(cells, size):
        for k, context in enumerate(contexts):
            lots[k].append((context, byte, counts[at]))
    for k, lot in enumerate(lots):
        if not lot:
            continue
        yield from _by_segment(k, _added_up(*(np.concatenate(x) for x in zip(*lot, strict=True))))


def _segment(k: int, payloads: list[bytes]) -> tuple[bytes, bytes]:
    """Log odds (16ths) and check with level for every slot of a predictor's segment."""
    events = np.frombuffer(b"".join(payloads), _EVENT)
    _, group = np.unique(events["context"], return_inverse=True)
    events = events[np.bincount(group, events["n"])[group] >= LEAST_SEEN]  # over all ranges
    _, place, check = _where(k, events["context"])
    byte, n = events["byte"].astype(np.int64), events["n"].astype(np.float64)
    slots, zeros, ones, owner = [], [], [], []
    for b in range(8):
        node = (1 << b) | (byte >> (8 - b))
        bit = (byte >> (7 - b)) & 1
        slots.append(place ^ _NODE[k][node])
        owner.append(mixed(events["context"] ^ U64(b)) + node.astype(U64))
        ones.append(n * bit)
        zeros.append(n * (1 - bit))
    slot, owner, one, zero = (np.concatenate(x) for x in (slots, owner, ones, zeros))
    _, first, which = np.unique(owner, return_index=True, return_inverse=True)
    one, zero = np.bincount(which, one), np.bincount(which, zero)
    seen, slot, check = one + zero, slot[first], np.tile(check, 8)[first]
    best = np.lexsort((owner[first], seen, slot))
    last = np.ones(len(best), dtype=bool)
    last[:-1] = slot[best][1:] != slot[best][:-1]
    best = best[last]
    odds, info = np.zeros(_SEGMENT[k], dtype=np.int8), np.zeros(_SEGMENT[k], dtype=np.uint8)
    value = np.log((one[best] + 0.4) / (zero[best] + 0.4))
    odds[slot[best]] = np.clip(np.rint(value * 16), -127, 127).astype(np.int8)
    level = 1 + (seen[best] >= 8).astype(np.uint8) + (seen[best] >= 64).astype(np.uint8)
    info[slot[best]] = (check[best] << 2) | level
    return odds.tobytes(), info.tobytes()


class Model:
    """Weights, last stage and shares; of fixed size. `tables` are odds and info of each predictor, or
    a broadcast of them."""

    def __init__(self, tables):
        self.tables = tables
        self.weights = np.zeros((LEVELS, 8, PREDICTORS + 1))
        self.weights[:, :, :PREDICTORS] = 0.3
        self.last = None
        #: training units, and the share of units that come from the counts
        self.n_units, self.known = 0, 0.0
        #: share of a guess by the right guesses before it
        self.trust = np.zeros(GUESSES)

    def bits(self, cells: np.ndarray, size: np.ndarray, before: np.ndarray | None = None, first: int = 0, last: int = WIDTH):
        """For every bit of every unit, or of some of its bytes: the rows, the bit, its place, the gate and the inputs."""
        odds, infos = self.tables if isinstance(self.tables, tuple) else self.tables.value
        for rows, byte, contexts in _contexts(cells, size, before, first, last):
            found = [_where(k, c) for k, c in enumerate(contexts)]
            for b in range(8):
                node = (1 << b) | (byte >> (8 - b))
                inputs = np.ones((PREDICTORS + 1, len(rows)), dtype=np.float32)
                for k, (segment, place, check) in enumerate(found):
                    at = segment * _SEGMENT[k] + (place ^ _NODE[k][node])
                    info = infos[k][at]
                    known = (info >> 2 == check) & (info > 0)
                    np.multiply(odds[k][at], known, out=inputs[k], casting="unsafe", dtype=np.float32)
                inputs[:PREDICTORS] *= np.float32(1 / 16)
                gate = (info & 3) * known  # of the last one, the word so far
                yield rows, (byte >> (7 - b)) & 1, b, gate, inputs

    def mix(self, b: int, gate: np.ndarray, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = np.ascontiguousarray(self.weights[:, b].T)
        z = np.clip(sum(weights[k][gate] * inputs[k] for k in range(PREDICTORS + 1)), -12, 12)
        return z, 1 / (1 + np.exp(-z))

    def refined(self, b: int, z: np.ndarray, p: np.ndarray) -> np.ndarray:
        if self.last is None:
            return p
        place = (z + 12) * ((BUCKETS - 1) / 24)
        low = np.minimum(place.astype(np.int64), BUCKETS - 2)
        part = place - low
        return 0.75 * p + 0.25 * (self.last[b, low] * (1 - part) + self.last[b, low + 1] * part)

    def score(self, cells: np.ndarray, size: np.ndarray, before: np.ndarray | None = None, first: int = 0, last: int = WIDTH) -> np.ndarray:
        """log10 probability of every unit, or of some of its bytes."""
        out = np.zeros(len(size))
        for rows, bit, b, gate, inputs in self.bits(cells, size, before, first, last):
            p = self.refined(b, *self.mix(b, gate, inputs))
            out[rows] += np.log10(np.where(bit == 1, p, 1 - p))
        return out

    def heads(self, u: _Units) -> np.ndarray:
        """log10 probability of the first `REACH` bytes of every unit of some texts, after the bytes before it."""
        out, before, rows = np.zeros(len(u.which)), u.before(), np.arange(len(u.which))
        size = u.size[u.which]
        for j, key in _first_bytes(u, before, rows):
            rows = rows[size[rows] > j]
            places = U64(len(key).bit_length())
            if places <= U64(64 - _KEY_BITS):  # sorting values is quicker than sorting their places
                key = np.sort((key << places) | np.arange(len(key), dtype=U64))
                order, key = (key & ((U64(1) << places) - U64(1))).astype(np.int64), key >> places
            else:
                order = np.argsort(key)
                key = key[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            own = rows[order[new]]
            scored = self.score(u.cells[u.which[own], :REACH], np.full(len(own), j + 1), before[own], j, j + 1)
            out[rows[order]] += scored[np.cumsum(new) - 1]
        return out

    def counted(self, times: np.ndarray) -> np.ndarray:
        """What units that the training documents hold so often get from the counts."""
        return self.known * times / max(1, self.n_units)

    def learn(
        self, cells: np.ndarray, size: np.ndarray, n: np.ndarray, before: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Online over lots of units, each bit's error moving its gate's weights; returns the mass that
        each set of weights has seen, and seen mass and ones by the last stage's buckets."""
        mass = np.zeros((LEVELS, 8))
        seen = np.zeros((2, 8, BUCKETS))
        curves = np.full(self.weights.shape, FIRM)
        for lo in range(0, len(size), LOT):
            own = n[lo : lo + LOT].astype(np.float64)
            some = None if before is None else before[lo : lo + LOT]
            for rows, bit, b, gate, inputs in self.bits(cells[lo : lo + LOT], size[lo : lo + LOT], some):
                z, p = self.mix(b, gate, inputs)
                w = own[rows]
                bucket = np.rint((z + 12) * ((BUCKETS - 1) / 24)).astype(np.int64)
                seen[0, b] += np.bincount(bucket, w, BUCKETS)
                seen[1, b] += np.bincount(bucket, w * bit, BUCKETS)
                for g in np.unique(gate):
                    at = gate == g
                    x, wg = inputs[:, at].T, w[at]
                    slope = ((bit[at] - p[at]) * wg) @ x
                    curve = (p[at] * (1 - p[at]) * wg) @ (x * x)
                    curves[g, b] = np.maximum(FIRM, MEMORY * curves[g, b] + curve)
                    self.weights[g, b] += RATE * slope / curves[g, b]
                    mass[g, b] += wg.sum()
        return mass, seen[0], seen[1]


# ---- steps -------------------------------------------------------------------------------------


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _lowered(column) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = column_bytes(column)
    return _LOWER[data], offsets


def _send_counts(splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = _OverUnits(len(splitters) + 1)
        for whole in batches:
            for batch in cut(whole):
                fold = batch["fold"].to_numpy(zero_copy_only=False)
                u = _Units(*_lowered(batch["text"]))
                counts = [u.times(fold != HELD_OUT), u.times((fold != HELD_OUT) & (fold != FOR_WEIGHTS))]
                own = np.flatnonzero((fold == FOR_WEIGHTS)[u.row])
                tried, right, gate = _repeats(u.which[own], u.row[own])
                guesses = np.concatenate([np.bincount(gate[x], minlength=GUESSES) for x in (tried, right)])
                some = int(len(u.which) % (len(splitters) + 1))  # block -1: counts of guesses, for any range
                yield from B.sent(-1, np.repeat([0, 1], [some + 1, len(splitters) + 1 - some]), lambda a, b, n=guesses: n.astype("<i8").tobytes()).to_batches()
                chosen, cuts = _laid_out(u, np.flatnonzero(counts[0] > 0), splitters)
                yield from B.sent(0, cuts, lambda a, b, c=chosen, u=u, n=counts: _packed(u, c[a:b], n)).to_batches()
                # what a unit that no predictor counts here follows: the weights may learn from it
                before = u.before()
                pairs = _Following(u, before, own[counts[1][u.which[own]] == 0])
                chosen, cuts = _laid_out(pairs, np.arange(len(pairs.size)), splitters)
                yield from B.sent(-2, cuts, lambda a, b, c=chosen, u=pairs: _packed(u, c[a:b], u.counts)).to_batches()
                over.add(u, before, np.flatnonzero(((fold != HELD_OUT) & (fold != FOR_WEIGHTS))[u.row]))
                if over.full():
                    yield from over.send().to_batches()
        yield from over.send().to_batches()

    return run


class _Following:
    """Distinct units of some places of texts, each with the bytes before it, and their counts."""

    def __init__(self, u: _Units, before: np.ndarray, places: np.ndarray):
        key = mixed(before[places]) ^ mixed(u.which[places].astype(U64) + U64(1))
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        which, before = u.which[places[first]], before[places[first]]
        self.cells, self.size, self.word, self.tail = u.cells[which], u.size[which], u.word[which], u.tail[which]
        self.counts = [n, before & U64(0xFFFFFFFF), before >> U64(32)]


def _meet_counts(part: int, lots: int, blocks: list[int], payloads: list[bytes]) -> pa.Table:
    """kind 0: the range's distinct words, word tokens, units, and of the units for the weights all and
    those that the predictors know, and tried and right guesses; kind 1: units for the weights, dealt into
    lots; kind 2 and on: events of a predictor's segment."""
    guesses = sum(np.frombuffer(p, "<i8") for p, b in zip(payloads, blocks, strict=True) if b == -1) + np.zeros(2 * GUESSES, "<i8")
    pairs = [p for p, b in zip(payloads, blocks, strict=True) if b == -2]
    over = [p for p, b in zip(payloads, blocks, strict=True) if b == OVER_UNITS]
    payloads = [p for p, b in zip(payloads, blocks, strict=True) if b >= 0]
    met = _Met(payloads or [np.uint32(0).tobytes()], 2)
    begins = met.word > 0
    left = met.counts[0] - met.counts[1]
    totals = (
        len(np.unique(met.words()[begins])),
        met.counts[0][begins].sum(),
        met.counts[0].sum(),
        left.sum(),
        left[met.counts[1] > 0].sum(),
    )
    rows = [(0, part, np.array([*totals, *guesses], dtype="<i8").tobytes())]
    cells, size, word, tail, (n, near, reach) = _joined(pairs, 3)
    before = (reach.astype(U64) << U64(32)) | near.astype(U64)
    unit = _unit_keys(cells, size, word, tail)
    new = ~np.isin(unit, _unit_keys(met.cells, met.size, met.word, met.tail)[met.counts[1] > 0])
    lot = (_content(cells, size) % U64(lots)).astype(np.int64)  # a range's words are all alike
    for own in range(lots):
        at = np.flatnonzero(new & (lot == own))
        if len(at):
            _, first, same = np.unique(unit[at] ^ mixed(before[at]), return_index=True, return_inverse=True)
            times, at = np.bincount(same, n[at]), at[first]
            payload = (np.uint32(len(at)), size[at].astype(np.uint8), times.astype("<i8"), before[at].astype("<u8"), cells[at])
            rows.append((1, own, b"".join(x.tobytes() for x in payload)))
    rows += [(2 + segment, part, payload) for segment, payload in _OverUnits.met(over)]
    rows += [(2 + segment, part, payload) for segment, payload in _events(met, (met.counts[1] > 0).astype(np.int64))]
    kind, own, payload = zip(*rows, strict=True)
    return pa.table({"kind": pa.array(kind, pa.int32()), "part": pa.array(own, pa.int32()), "payload": pa.array(payload, pa.binary())})


def _for_weights(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    size = np.frombuffer(payload, np.uint8, n, 4).astype(np.int64)
    times, before = np.frombuffer(payload, "<i8", n, 4 + n), np.frombuffer(payload, "<u8", n, 4 + 9 * n)
    return np.frombuffer(payload, np.uint8, n * WIDTH, 4 + 17 * n).reshape(n, WIDTH), size, times, before


def _learn(model):
    def run(key, table):
        cells, size, n, before = (np.concatenate(x) for x in zip(*map(_for_weights, table["payload"].to_pylist()), strict=True))
        order = np.argsort(_content(cells, size) ^ mixed(before))  # without meaning, and always the same
        own = Model(model.tables)
        own.weights = model.weights.copy()
        mass, seen, ones = own.learn(cells[order], size[order], n[order], before[order])
        sums = np.concatenate([(own.weights * mass[:, :, None]).ravel(), mass.ravel(), seen.ravel(), ones.ravel()])
        return pa.table({"sums": pa.array([sums], pa.list_(pa.float64()))})

    return run


def _summed(rows: DataFrame) -> np.ndarray | None:
    """Element-wise sums of the rows' arrays, added up on the executors."""
    sums = rows.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()
    return np.array([r["x"] for r in sums]) if sums else None


def train(docs: DataFrame) -> tuple[Model, int, int, int]:
    """The model, and distinct words, word tokens and documents of the training documents."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _fold(F.col("doc_id")).alias("fold"))
    total = rows.agg(F.sum(F.octet_length("text")), F.sum((F.col("fold") != HELD_OUT).cast("long"))).first()
    parts = max(8, (total[0] or 0) // (8 * B.BLOCK_BYTES))
    lots = max(1, parts // 8)
    splitters = _splitters(docs, parts)
    sent = rows.filter(F.col("fold") != HELD_OUT).select("text", "fold").mapInArrow(_send_counts(splitters), B.SENT)
    met = written(
        sent.groupBy("part").applyInArrow(
            lambda key, t: _meet_counts(key[0].as_py(), lots, t["block"].to_pylist(), t["payload"].to_pylist()), "kind int, part int, payload binary"
        ),
        "units",
    )
    counts = [np.frombuffer(r["payload"], "<i8") for r in met.filter("kind = 0").select("payload").collect()]
    n_words, n_tokens, n_units, tried, known, *guesses = sum(counts, np.zeros(5 + 2 * GUESSES, dtype=np.int64)).tolist()

    def segment(key, t):
        odds, info = _segment((key[0].as_py() - 2) // SEGMENTS, t["payload"].to_pylist())
        kinds = pa.schema([("kind", pa.int32()), ("odds", pa.binary()), ("info", pa.binary())])
        return pa.table({"kind": [key[0].as_py()], "odds": [odds], "info": [info]}, schema=kinds)

    odds = [np.zeros(n, dtype=np.int8) for n in SLOTS]
    info = [np.zeros(n, dtype=np.uint8) for n in SLOTS]
    made = met.filter("kind > 1").groupBy("kind").applyInArrow(segment, "kind int, odds binary, info binary")
    for r in made.toLocalIterator():  # segments of fixed size and number
        k, s = divmod(r["kind"] - 2, SEGMENTS)
        at = slice(s * _SEGMENT[k], (s + 1) * _SEGMENT[k])
        odds[k][at], info[k][at] = np.frombuffer(r["odds"], np.int8), np.frombuffer(r["info"], np.uint8)
    model = Model(spark.sparkContext.broadcast((odds, info)))
    model.n_units, model.known = n_units, known / tried if tried else 0.0
    model.trust = (np.array(guesses[GUESSES:]) + 0.1) / (np.array(guesses[:GUESSES]) + 2.0)
    units = met.filter("kind = 1").select("part", "payload")
    for _ in range(ROUNDS):
        sums = _summed(units.groupBy("part").applyInArrow(_learn(model), "sums array<double>"))
        if sums is not None:
            n = model.weights.size
            moved, mass = sums[:n].reshape(model.weights.shape), sums[n : n + LEVELS * 8].reshape(LEVELS, 8, 1)
            model.weights = np.where(mass > 0, moved / np.maximum(mass, 1e-9), model.weights)
            seen, ones = sums[n + LEVELS * 8 :].reshape(2, 8, BUCKETS)
            centre = 1 / (1 + np.exp(-np.linspace(-12, 12, BUCKETS)))
            model.last = (ones + 4 * centre) / (seen + 4)
    return model, n_words, n_tokens, int(total[1] or 0)


def _splitters(docs: DataFrame, parts: int) -> np.ndarray:
    u = _Units(*_lowered(pa.array(B.sampled_texts(docs), pa.string())))
    strings = np.sort(_word_strings(u.cells, u.word, u.size))
    return np.unique(strings[np.arange(1, parts) * len(strings) // parts]) if len(strings) else strings


#: A word's count, and of a unit what the counts give it and the score of its bytes from `REACH` on.
_ANSWER = np.dtype([("count", "<u8"), ("counted", "<f4"), ("score", "<f4")])


class _Score:
    def __init__(self, model, splitters: np.ndarray, end_count: int):
        self.model, self.splitters, self.end_count = model, splitters, end_count

    def units(self, table: pa.Table):
        data, offsets = _lowered(table["text"])
        u = _Units(data, offsets)
        return u, offsets, *_laid_out(u, np.arange(len(u.size)), self.splitters)

    def ask(self, key, table: pa.Table) -> pa.Table:
        table = B.ordered(table)
        u, _, chosen, cuts = self.units(table)
        counts = [u.times(table["rest"].combine_chunks().field("fold").to_numpy(zero_copy_only=False) != HELD_OUT)]
        return B.sent(key[0].as_py(), cuts, lambda a, b: _packed(u, chosen[a:b], counts))

    def answer(self, key, table: pa.Table) -> pa.Table:
        met = _Met(table["payload"].to_pylist(), 1)
        words = met.words()
        out = np.empty(len(met.size), dtype=_ANSWER)
        out["count"] = np.bincount(words, met.counts[0]).astype(np.int64)[words]
        for lo in range(0, len(out), 16 * LOT):
            at = slice(lo, lo + 16 * LOT)
            out["score"][at] = self.model.score(met.cells[at], met.size[at], None, REACH)
        out["counted"] = self.model.counted(met.counts[0])
        replies = [out[w].tobytes() for w in np.split(met.which, met.ends)]
        n = len(replies)
        return pa.table(
            {
                "block": table["block"],
                "round": pa.array([1] * n, pa.int32()),
                "part": pa.array([key[0].as_py()] * n, pa.int32()),
                "payload": pa.array(replies, pa.binary()),
            }
        )

    def with_guesses(self, u: _Units, score: np.ndarray) -> np.ndarray:
        tried, right, gate = _repeats(u.which, u.row)
        out, share = score.astype(np.float64), self.model.trust[gate[tried]]
        out[tried] = np.log10(share * right[tried] + (1 - share) * 10.0 ** out[tried])
        return out

    def finish(self, key, table: pa.Table, answers: pa.Table) -> pa.Table:
        table = B.ordered(table)
        u, offsets, chosen, cuts = self.units(table)
        got = np.zeros(len(u.size), dtype=_ANSWER)
        for part, payload in zip(answers["part"].to_pylist(), answers["payload"].to_pylist(), strict=True):
            got[chosen[cuts[part] : cuts[part + 1]]] = np.frombuffer(payload, _ANSWER)
        n = len(offsets) - 1
        bits = self.model.heads(u) + got["score"][u.which]
        unit = np.log10(got["counted"][u.which] + (1 - self.model.known) * 10.0**bits)
        begins = (u.word > 0)[u.which]
        count = got["count"][u.which][begins].astype(np.float64)
        row = u.row[begins]
        base = np.bincount(row, np.log10(count + 1), n) + np.log10(self.end_count + 1)
        known = np.bincount(row, count > 0, n).astype(np.int64) + (self.end_count > 0)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "text": table["text"],
                "rest": table["rest"],
                "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                "n_tokens": pa.array(np.bincount(row, minlength=n) + 1, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "seen": pa.array(base, pa.float64()),
                "score": pa.array(np.bincount(u.row, self.with_guesses(u, unit), n), pa.float64()),
            }
        )


def score(docs: DataFrame) -> DataFrame:
    """doc_id, text, rest (fold and a struct of the other columns), held_out, n_bytes, n_tokens, n_known,
    train_tokens, base_score, score and bits_per_byte."""
    return _scored(docs)[0]


def _scored(docs: DataFrame) -> tuple[DataFrame, B.Dealt]:
    model, n_words, n_tokens, n_docs = train(docs)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    more = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    dealt = B.deal(docs.select("doc_id", "text", _fold(F.col("doc_id")).alias("fold"), more.alias("more")))
    splitters = _splitters(docs, max(8, dealt.blocks // 8))
    steps = _Score(model, splitters, n_docs)
    answers = (
        dealt.docs.groupBy("block")
        .applyInArrow(lambda key, t: steps.ask(key, t), B.SENT)
        .groupBy("part")
        .applyInArrow(lambda key, t: steps.answer(key, t), B.BACK)
    )
    found = (
        dealt.docs.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            lambda key, t, a: steps.finish(key, t, a),
            B.with_columns(dealt, "n_bytes long, n_tokens long, n_known long, seen double, score double"),
        )
    )
    size = float(n_tokens + n_docs + n_words + (n_docs > 0) + 1)
    scored = found.select(
        "doc_id",
        "text",
        "rest",
        (F.col("rest")["fold"] == HELD_OUT).alias("held_out"),
        "n_bytes",
        "n_tokens",
        "n_known",
        F.lit(n_tokens + n_docs).cast("long").alias("train_tokens"),
        (F.col("seen") - F.col("n_tokens") * F.log10(F.lit(size))).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
    return scored, dealt


def digest(docs: DataFrame) -> DataFrame:
    scored, dealt = _scored(docs.select("doc_id", "text"))
    return dealt.few_files(
        scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    )
