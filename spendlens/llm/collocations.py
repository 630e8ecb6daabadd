"""Phrase collocations, counted in quotient filters.

Texts are cut once: each lot of texts becomes a run of codes into the lot's own word list, with a break
between pieces, and both are kept in the shared folder; no later step sees a text. Words are counted over
all lots; those that occur often enough get numbers, and each lot swaps its codes for them, with a break
in place of any other word, which no wanted phrase can hold.

Phrases of two words and more are then counted level by level. An n-gram of word numbers is packed into
one or more 64-bit lanes and put through an invertible permutation. The permuted number is split into a
quotient, which is stored as the place of an entry in a bit string, and the remainder, which is stored
in full beside a counter of one byte that spills into a list; so a filter is compact, loses nothing, and
its entries stay in order. Tasks make sorted filters of bounded size, cut at the leading bits; those of
one range are merged as sorted runs, their counts added, and what is frequent is turned back into words.
Ranges are made finer in hops of HOP bits, so that a filter that travels never gets tiny. A phrase is
only counted at a place where both its parts of one word less may be frequent, which a bitmap of leading bits
of those tells (of bounded size; it lets some others through, whose exact count then shows).

Defined results: a null text has no words; a null lang is `und`, together with the lang of that name; an
empty table, or one without frequent phrases, gives an empty result; words may be of any length; rows that
repeat a doc_id all count; further columns do not matter. Arithmetic is exact: counts are 64-bit, products
are decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import files_for, written
from .text import U64, column_bytes, cut, lots, mixed

LEAST, LONGEST, FIRST = 100, 5, 2_000
#: Bytes of text that are cut at once, windows that make one filter, entries of a range, bits of a hop.
LOT, WINDOWS, ENTRIES, HOP = 1 << 20, 1 << 19, 1 << 19, 8
#: Bytes of filters that are merged at once between two hops.
MERGED = 1 << 25
#: The bitmap of frequent phrases: bits for each, and the most bits of a place in it (32 MiB).
ROOM, PLACES = 16, 28
SALTS = 32
NO_LANG = "und"

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.zeros(256, dtype=np.uint8)  # 0 inside a word, 1 blank, 2 end of a piece
_KIND[list(b" \t")] = 1
_KIND[list(_SEPARATORS)] = 2


# ------------------------------------------------------------------ texts to codes


class Cut:
    """The words of a run of texts as codes of its own list, with breaks between pieces."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        lengths = np.concatenate([[0], np.cumsum(ends - starts)])
        buffers = [None, pa.py_buffer(lengths), pa.py_buffer(data[inside])]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        owner = np.searchsorted(offsets, starts, side="right") - 1
        code = words.indices.to_numpy().astype(np.int64) + langs[owner] * max(1, len(words.dictionary))
        known, place, self.counts = np.unique(code, return_inverse=True, return_counts=True)
        self.langs, which = np.divmod(known, max(1, len(words.dictionary)))
        self.words = words.dictionary.take(pa.array(which)).cast(pa.binary())
        # a word goes on with the piece of the word before it, or a break comes first
        piece = np.cumsum(kind == 2)[starts] if len(starts) else np.zeros(0, int)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
        self.codes = np.zeros(len(starts) + int(new.sum()), dtype="<u4")
        self.codes[np.arange(len(starts)) + np.cumsum(new)] = place + 1


CODED = "lot long, codes binary, code int, lang string, word binary, n long"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lot = TaskContext.get().partitionId() << 32
    names = [f.split()[0] for f in CODED.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.string(), pa.binary(), pa.int64()]
    for whole in batches:
        for batch in cut(whole, LOT):
            data, offsets = column_bytes(batch["text"])
            own = batch["lang"].dictionary_encode()
            langs = own.indices.to_numpy().astype(np.int64)
            for part, part_offsets, whose in lots(data, offsets, LOT, _SEPARATORS):
                made = Cut(part, part_offsets, langs[whose])
                lot, n = lot + 1, len(made.words)
                first = [[lot], [made.codes.tobytes()], *([[None]] * 4)]
                rest = [
                    np.full(n, lot), pa.nulls(n, pa.binary()), np.arange(1, n + 1, dtype=np.int32),
                    own.dictionary.take(pa.array(made.langs)), made.words, made.counts,
                ]
                for columns in (first, rest):
                    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)


def coded(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lot, codes; and lot, code, lang, word, n."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    both = written(rows.mapInArrow(_coded, CODED), "coded")
    return both.filter("codes is not null").select("lot", "codes"), both.filter("codes is null").drop("codes")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written in files of a good size: one for a small table, and every file costs its writer a process."""
    return written(df.hint("rebalance"), name)


def frequent_words(listed: DataFrame, least: int) -> tuple[DataFrame, int]:
    """id, lang, word, n of the words that occur often enough, numbered from 1; and their number.

    Numbers are given inside hash buckets and shifted by the buckets before."""
    found = listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    found = _kept(found, "frequent-words")
    count = found.count()
    buckets = files_for(count, 50_000)
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(buckets)))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    shifts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    numbered = dealt.withColumn("place", place).join(shifts, "bucket")
    ids = numbered.select((F.col("shift") + F.col("place")).alias("id"), "lang", "word", "n")
    return _kept(ids, "word-numbers"), count


def _numbered(kind: str):
    def swap(codes: pa.Table, known: pa.Table) -> pa.Table:
        out, sizes = [], []
        table = np.zeros(1 + known["code"].to_numpy().max(initial=0), dtype=np.int64)
        table[known["code"].to_numpy()] = known["id"].to_numpy()
        for raw in codes["codes"].to_pylist():
            codes_here = np.frombuffer(raw, "<u4")
            ids = np.where(codes_here < len(table), table[np.minimum(codes_here, len(table) - 1)], 0)
            # a word by itself is no phrase, and one break is as good as many
            there = np.concatenate([[False], ids > 0, [False]])
            useful = there[1:-1] & (there[:-2] | there[2:])
            kept = useful | (np.concatenate([[False], useful[:-1]]) & ~useful)
            short = ids[kept]
            short[~useful[kept]] = 0
            out.append(short.astype(kind).tobytes())
            sizes.append(len(short))
        return pa.table({"ids": pa.array(out, pa.binary()), "size": pa.array(sizes, pa.int64())})

    return swap


def numbered(codes: DataFrame, listed: DataFrame, words: DataFrame, kind: str) -> DataFrame:
    """ids, size: runs of the numbers of frequent words, with breaks of 0."""
    known = listed.join(words.select("lang", "word", "id"), ["lang", "word"])
    known = known.select(F.col("lot").alias("lot"), "code", "id")  # both sides come from one table
    met = codes.groupBy("lot").cogroup(known.groupBy("lot")).applyInArrow(_numbered(kind), "ids binary, size long")
    return written(met.filter("size > 0"), "numbered")


# ------------------------------------------------------------------ n-grams as permuted numbers


def _mask(width: int) -> np.uint64:
    return U64((1 << width) - 1)


class Packing:
    """n-grams of word numbers of so many bits, in lanes of whole words, and the permutation of them."""

    _ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

    def __init__(self, words: int, bits: int):
        each = 64 // bits
        self.bits = bits
        self.words = [min(each, words - at) for at in range(0, words, each)]
        self.widths = [n * bits for n in self.words]

    def lanes(self, ids: np.ndarray) -> list[np.ndarray]:
        """Of the n-gram at every place of a run of numbers, permuted."""
        n = len(ids) - sum(self.words) + 1
        out, at = [], 0
        for words in self.words:
            lane = np.zeros(n, dtype=U64)
            for _ in range(words):
                lane = (lane << U64(self.bits)) | ids[at : at + n]
                at += 1
            out.append(lane)
        return self._permuted(out)

    def _stir(self, lane: np.ndarray) -> np.ndarray:
        width = self.widths[0]
        for odd in self._ODD:
            lane = (lane * U64(odd)) & _mask(width)
            lane = lane ^ (lane >> U64((width + 1) // 2))
        return lane

    def _unstir(self, lane: np.ndarray) -> np.ndarray:
        width = self.widths[0]
        for odd in reversed(self._ODD):
            lane = lane ^ (lane >> U64((width + 1) // 2))
            lane = (lane * U64(pow(odd, -1, 1 << 64))) & _mask(width)
        return lane

    def _crossed(self, lanes: list[np.ndarray], first: bool) -> list[np.ndarray]:
        """Either the first lane into the others, or the others into the first; each undoes itself."""
        head, *rest = lanes
        if first:
            return [head, *(r ^ (mixed(head + U64(i)) & _mask(w)) for i, (r, w) in enumerate(zip(rest, self.widths[1:]), 1))]
        for i, lane in enumerate(rest, 1):
            head = head ^ (mixed(lane + U64(i)) & _mask(self.widths[0]))
        return [head, *rest]

    def _permuted(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        lanes = self._crossed([self._stir(lanes[0]), *lanes[1:]], True)
        return self._crossed(lanes, False)

    def ids(self, lanes: list[np.ndarray]) -> np.ndarray:
        """The n-grams, a row each, of permuted lanes."""
        lanes = self._crossed(self._crossed(lanes, False), True)
        lanes = [self._unstir(lanes[0]), *lanes[1:]]
        columns = [
            (lane >> U64(self.bits * (words - 1 - i))) & _mask(self.bits)
            for lane, words in zip(lanes, self.words, strict=True)
            for i in range(words)
        ]
        return np.stack(columns, axis=1).astype(np.int64)

    def place(self, lanes: list[np.ndarray], bits: int) -> np.ndarray:
        """The leading bits."""
        if not bits:
            return np.zeros(len(lanes[0]), dtype=np.int64)
        return (lanes[0] >> U64(self.widths[0] - bits)).astype(np.int64)


# ------------------------------------------------------------------ counting quotient filters


def _bytes_of(values: np.ndarray, width: int) -> bytes:
    size = -(-width // 8)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _values_of(raw: bytes, at: int, n: int, width: int) -> tuple[np.ndarray, int]:
    size = -(-width // 8)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8, n * size, at).reshape(n, size)
    return out.reshape(-1).view("<u8").astype(U64), at + n * size


def filter_of(lanes: list[np.ndarray], counts: np.ndarray, widths: list[int], ranged: int) -> bytes:
    """A counting quotient filter of sorted entries that agree in the first `ranged` bits.

    The quotient is the next bits, about as many as make a place for each entry: entry i with quotient q
    is bit q + i of a bit string. The remainder, all further bits, is stored in full."""
    n, free = len(counts), widths[0] - ranged
    quotient_bits = min(free, n.bit_length())
    rest = free - quotient_bits
    quotient = ((lanes[0] & _mask(free)) >> U64(rest)).astype(np.int64)
    runs = np.zeros((1 << quotient_bits) + n, dtype=np.uint8)
    runs[quotient + np.arange(n)] = 1
    many = np.flatnonzero(counts >= 255)
    prefix = int(lanes[0][0] >> U64(free)) if ranged else 0
    return b"".join(
        [
            np.array([n, quotient_bits, prefix, len(many)], dtype="<i8").tobytes(),
            np.packbits(runs).tobytes(),
            _bytes_of(lanes[0] & _mask(rest), rest),
            *(_bytes_of(lane, width) for lane, width in zip(lanes[1:], widths[1:], strict=True)),
            np.minimum(counts, 255).astype(np.uint8).tobytes(),
            counts[many].astype("<i8").tobytes(),
        ]
    )


def entries_of(raw: bytes, widths: list[int], ranged: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The lanes and counts of a filter."""
    n, quotient_bits, prefix, many = np.frombuffer(raw, "<i8", 4).tolist()
    free = widths[0] - ranged
    rest = free - quotient_bits
    at, size = 32, (1 << quotient_bits) + n
    runs = np.unpackbits(np.frombuffer(raw, np.uint8, -(-size // 8), at), count=size)
    at += -(-size // 8)
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(U64)
    low, at = _values_of(raw, at, n, rest)
    head = (quotient << U64(rest)) | low
    if ranged:
        head |= U64(prefix) << U64(free)
    lanes = [head]
    for width in widths[1:]:
        lane, at = _values_of(raw, at, n, width)
        lanes.append(lane)
    counts = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", many, at + n)
    return lanes, counts


def _summed(lanes: list[np.ndarray], counts: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries in order, equal ones as one. Runs that are sorted already are merged as such."""
    order = np.lexsort(lanes[::-1]) if len(lanes) > 1 else np.argsort(lanes[0], kind="stable")
    lanes = [lane[order] for lane in lanes]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([lane[1:] != lane[:-1] for lane in lanes], axis=0)
    starts = np.flatnonzero(new)
    if counts is None:
        counts = np.diff(np.append(starts, len(order)))
    elif len(starts):
        counts = np.add.reduceat(counts[order], starts)
    return [lane[starts] for lane in lanes], counts


FILTERS = "part long, lot int, filter binary"


def _cut_up(packing: Packing, lanes: list[np.ndarray], counts: np.ndarray, ranged: int, lot: int) -> pa.RecordBatch:
    """Sorted entries as a filter for each range of the first bits."""
    parts, starts = np.unique(packing.place(lanes, ranged), return_index=True)
    ends = np.append(starts[1:], len(counts))
    filters = [
        filter_of([lane[a:b] for lane in lanes], counts[a:b], packing.widths, ranged)
        for a, b in zip(starts, ends, strict=True)
    ]
    columns = [pa.array(parts, pa.int64()), pa.array([lot] * len(parts), pa.int32()), pa.array(filters, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["part", "lot", "filter"])


def _merged(packing: Packing, filters: pa.Table, ranged: int) -> tuple[list[np.ndarray], np.ndarray]:
    found = [entries_of(raw, packing.widths, ranged) for raw in filters["filter"].to_pylist()]
    lanes = [np.concatenate([f[0][i] for f in found]) for i in range(len(packing.widths))]
    return _summed(lanes, np.concatenate([f[1] for f in found]))


# ------------------------------------------------------------------ counting on Spark


def _counted(kind: str, packing: Packing, shorter: Packing | None, known, place_bits: int, ranged: int, lots_: int):
    """Filters of the n-grams of runs of word numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = sum(packing.words)
        held: list[list[np.ndarray]] = []
        windows, flushed = 0, TaskContext.get().partitionId()
        bitmap = None if known is None else np.frombuffer(known.value, np.uint8)

        def flush() -> pa.RecordBatch:
            lanes = [np.concatenate([h[i] for h in held]) for i in range(len(packing.widths))]
            return _cut_up(packing, *_summed(lanes, None), ranged, flushed % lots_)

        for batch in batches:
            for raw in batch["ids"].to_pylist():
                ids = np.frombuffer(raw, kind).astype(U64)
                if len(ids) < size:
                    continue
                # runs of `size` numbers without a break
                breaks = np.concatenate([[0], np.cumsum(ids == 0)])
                whole = breaks[size:] == breaks[:-size]
                if bitmap is not None:
                    at = shorter.place(shorter.lanes(ids), place_bits)
                    may = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    whole &= may[:-1] & may[1:]
                there = np.flatnonzero(whole)
                if not len(there):
                    continue
                held.append([lane[there] for lane in packing.lanes(ids)])
                windows += len(there)
                if windows >= WINDOWS:
                    yield flush()
                    held.clear()
                    windows, flushed = 0, flushed + 1
        if held:
            yield flush()

    return count


def _recut(packing: Packing, ranged: int, finer: int):
    def recut(filters: pa.Table) -> pa.Table:
        lot = filters["lot"][0].as_py()
        return pa.Table.from_batches([_cut_up(packing, *_merged(packing, filters, ranged), finer, lot)])

    return recut


FOUND = "ids array<long>, a long, lead long"


def _frequent(packing: Packing, ranged: int, least: int):
    def frequent(filters: pa.Table) -> pa.Table:
        lanes, counts = _merged(packing, filters, ranged)
        enough = counts >= least
        lanes = [lane[enough] for lane in lanes]
        ids = packing.ids(lanes)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(ids) + 1) * ids.shape[1], pa.int32()), pa.array(ids.reshape(-1), pa.int64())
        )
        lead = (lanes[0] << U64(64 - packing.widths[0])).view(np.int64)
        return pa.table({"ids": lists, "a": pa.array(counts[enough], pa.int64()), "lead": pa.array(lead, pa.int64())})

    return frequent


def _bitmap(found: DataFrame, packing: Packing, count: int) -> tuple[bytes, int]:
    """Bits at the leading bits of all frequent n-grams: never more than 2 ** PLACES of them."""
    bits = min(PLACES, packing.widths[0], max(3, (count * ROOM).bit_length()))
    place = F.shiftrightunsigned("lead", 64 - bits) + 1
    rows = (
        found.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    whole = bytearray(max(1 << bits, 1 << 15) // 8)
    for row in rows:
        at = (row["bucket"] - 1) * 4096
        whole[at : at + 4096] = row["bits"]
    return bytes(whole), bits


def phrases(runs: DataFrame, words: int, least: int, longest: int, kind: str) -> list[DataFrame]:
    """ids, a of the frequent phrases of 2, 3, ... words."""
    spark = runs.sparkSession
    bits = max(1, words.bit_length())
    total = runs.agg(F.sum("size")).first()[0] or 0
    levels: list[DataFrame] = []
    shorter, known, place_bits = None, None, 0
    for size in range(2, longest + 1):
        packing = Packing(size, bits)
        finest = min(packing.widths[0], max(0, (total // ENTRIES).bit_length()))
        ranged = min(HOP, finest)
        lots_ = max(1, total * 8 // (MERGED << ranged)) if ranged < finest else 1
        count = _counted(kind, packing, shorter, known, place_bits, ranged, lots_)
        filters = runs.select("ids").mapInArrow(count, FILTERS)
        while ranged < finest:
            finer = min(finest, ranged + HOP)
            filters = filters.groupBy("part", "lot").applyInArrow(_recut(packing, ranged, finer), FILTERS)
            ranged = finer
        found = filters.groupBy("part").applyInArrow(_frequent(packing, ranged, least), FOUND)
        found = _kept(found, f"phrases-{size}")
        n = found.count()
        if not n:
            break
        levels.append(found.select("ids", "a"))
        bitmap, place_bits = _bitmap(found, packing, n)
        shorter, known = packing, spark.sparkContext.broadcast(bitmap)
    return levels


# ------------------------------------------------------------------ scores


def _spelled(levels: list[DataFrame], words: DataFrame) -> DataFrame:
    """lang, phrase, k, a of all frequent words and phrases."""
    single = words.select("lang", F.col("word").cast("string").alias("phrase"), F.lit(1).alias("k"), F.col("n").alias("a"))
    if not levels:
        return single
    rows = levels[0]
    for more in levels[1:]:
        rows = rows.union(more)
    one = rows.select("ids", "a", F.posexplode("ids").alias("at", "id")).join(
        words.select("id", "lang", F.col("word").cast("string").alias("word")), "id"
    )
    spelled = one.groupBy("ids", "a").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words")
    )
    phrase = F.concat_ws(" ", F.col("words.word"))
    return single.union(spelled.select("lang", phrase.alias("phrase"), F.size("ids").alias("k"), "a"))


def _cuts(known: DataFrame, totals: DataFrame) -> DataFrame:
    """Every cut of every phrase: lang, phrase, k, a, n, cut, left, right, l, r, score."""
    words = F.split("phrase", " ")
    at = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = known.filter("k > 1").select("lang", "phrase", "k", "a", at).select(
        "lang", "phrase", "k", "a", "cut",
        F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    counts = known.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("a").alias("f"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts, (F.col("of") == F.col("lang")) & (F.col("part") == F.col(side))).withColumnRenamed(
            "f", name
        ).drop("of", "part")
    score = F.expr(
        "(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0))) div"
        " (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    )
    return cuts.join(totals, "lang").withColumn("score", score)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language."""
    codes, listed = coded(docs)
    words, count = frequent_words(listed, least)
    kind = "<u4" if count < 1 << 32 else "<u8"
    levels = phrases(numbered(codes, listed, words, kind), count, least, longest, kind)
    known = _kept(_spelled(levels, words), "phrases")
    totals = listed.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = _kept(_cuts(known, totals), "cuts")
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("at"))
    # a phrase lies in a longer one that is as frequent if it does in one that is a word longer
    same = [
        cuts.filter(f"k > 2 and cut = {at} and {count} = a").select("lang", F.col(part).alias("phrase"))
        for at, count, part in (("k - 1", "l", "left"), ("1", "r", "right"))
    ]
    kept = lowest.join(same[0].union(same[1]).distinct(), ["lang", "phrase"], "left_anti")
    scored = kept.select("lang", "phrase", "a", "at.l", "at.r", "n", "at.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = few.filter(F.col("place") <= first).drop("salt", "place")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, CAST(len(words) - k + 2 AS BIGINT)),
        lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
    FROM worded, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k
), known AS (
    SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), parts AS (
    SELECT lang, phrase, k, a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS l_part,
        array_to_string(string_split(phrase, ' ')[c + 1:k], ' ') AS r_part
    FROM (SELECT *, unnest(range(1, k)) AS c FROM known WHERE k > 1)
), cuts AS (
    SELECT p.*, x.a AS l, y.a AS r, t.n,
        CAST((CAST(1000 AS HUGEINT) * p.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
    FROM parts p
    JOIN known x ON x.lang = p.lang AND x.phrase = p.l_part
    JOIN known y ON y.lang = p.lang AND y.phrase = p.r_part
    JOIN totals t ON t.lang = p.lang
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_ones AS (
    SELECT DISTINCT s.lang, s.phrase
    FROM known s JOIN known b ON b.lang = s.lang AND b.k > s.k AND s.k > 1 AND b.a >= s.a
        AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
        phrase, a, l, r, n, score
    FROM lowest ANTI JOIN inner_ones USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
