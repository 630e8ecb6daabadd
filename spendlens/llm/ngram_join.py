"""Similarity join on word n-gram sets, by MinHash banding.

A document's n-grams are its runs of `n` consecutive words (all its words as one run if it has
fewer). Documents with one set are a class, and its least doc_id stands for it. Band and row counts
are chosen for a target recall at the threshold; representatives that agree in a band fall into one
candidate cluster, and inside a cluster all pairs are verified on the full sets, in square blocks of
bounded size, so a pair that agrees in many bands is verified once and no pair is lost to chance
inside a cluster. What leaves a block is a row per member (its links) and a spanning forest.

Defined results: a null, empty or blank text has no n-grams and links with nothing; documents of one
class link with each other; a null doc_id takes part as the least number and comes back null; rows
that repeat a doc_id are one document, with the one of their texts whose class is least (none first);
an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, files_for, written
from .text import NULL_ID, U64, Rolling, Words, column_bytes, cut, mixed, numbers

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Members of a block; a cluster with more is verified in pairs of blocks.
BLOCK = 256
#: Columns of a dense count matrix in one multiplication.
_SLAB = 4_096
#: N-grams of a block's members; longer documents make smaller blocks.
_GRAMS = 500_000


def banding(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 160) -> tuple[int, int]:
    """Bands and rows with the most rows a band (the fewest chance meetings) that keep the recall."""
    best = (most, 1)
    for rows in range(1, most + 1):
        miss = 1 - threshold**rows
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def n_grams(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of every text, one after the other, and where each text's begin."""
    data, offsets = column_bytes(column)
    words = Words(data, offsets)
    roll = Rolling(words.hashes())
    place = np.arange(len(words)) - words.first[:-1][words.owner]
    size = words.counts[words.owner]
    starts = np.flatnonzero((place + n <= size) | (place == 0))
    hashes = roll.runs(starts, np.minimum(starts + n, words.first[1:][words.owner[starts]]))
    owner = words.owner[starts]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(offsets)))


def _signatures(hashes: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash for each text with n-grams and each band."""
    full = np.flatnonzero(np.diff(first))
    out = np.empty((len(full), bands), dtype=U64)
    if not len(full):
        return out
    for band in range(bands):
        key = np.full(len(full), band + 1, dtype=U64)
        for row in range(rows):
            times, plus = mixed(np.array([band * rows + row + 1, -1 - band * rows - row]).astype(U64))
            key = mixed(key * U64(31) + np.minimum.reduceat(hashes * (times | U64(1)) + plus, first[full]))
        out[:, band] = key
    return out


def _class(grams: np.ndarray) -> bytes | None:
    return hashlib.sha256(grams.tobytes()).digest()[:16] if len(grams) else None


def _sketch(n: int, bands: int, rows: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_grams", pa.int64()), ("class", pa.binary()), ("bands", pa.list_(pa.int64()))]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in cut(whole):
                hashes, first = n_grams(batch["text"], n)
                sizes = np.diff(first)
                keys = _signatures(hashes, first, bands, rows).view(np.int64)
                classes = [_class(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers(batch["doc_id"])),
                        pa.array(sizes),
                        pa.array(classes, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                    ],
                    schema=schema,
                )

    return sketch


def _matches(sets: list[np.ndarray], others: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets (rows) reach the threshold with which of the others (columns)."""
    owner = np.repeat(np.arange(len(sets) + len(others)), [len(s) for s in (*sets, *others)])
    grams = np.concatenate([*sets, *others]) if len(owner) else np.zeros(0, U64)
    _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
    shared = times[which] > 1  # an n-gram of one member is in no intersection
    owner, which = owner[shared], which[shared]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    _, which = np.unique(which, return_inverse=True)
    both = np.zeros((len(sets), len(others)), dtype=np.float64)
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, _SLAB):
        a, b = np.searchsorted(which, [lo, lo + _SLAB])
        o, w = owner[a:b], which[a:b] - lo
        dense = np.zeros((len(sets) + len(others), int(w[-1]) + 1), dtype=np.float32)
        dense[o, w] = 1
        both += dense[: len(sets)] @ dense[len(sets) :].T
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    union = sizes[:, None] + np.array([len(s) for s in others], dtype=np.float64)[None, :] - both
    return both >= threshold * union - 1e-9


def _forest(matches: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the matches connect, at most one less than there are members."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for i in range(len(left)):
        for j in np.flatnonzero(matches[i]):
            a, b = find(int(left[i])), find(int(right[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((int(left[i]), int(right[j])))
    return edges


def _members(table: pa.Table, n: int) -> tuple[pa.Table, list[np.ndarray]]:
    """One row for each representative, by side and number, and its n-grams."""
    order = pc.sort_indices(table, sort_keys=[("side", "ascending"), ("rep", "ascending")])
    table, rows, sets = table.take(order), [], []
    reps, sides, classes = (table[c].to_pylist() for c in ("rep", "side", "class"))
    at = 0
    for whole in table.to_batches():
        for batch in cut(whole):
            hashes, first = n_grams(batch["text"], n)
            for a, b in zip(first[:-1], first[1:], strict=True):
                # rows that repeat a number: only the text whose class the others know, once
                again = rows and (reps[rows[-1]], sides[rows[-1]]) == (reps[at], sides[at])
                if _class(hashes[a:b]) == classes[at] and not again:
                    rows.append(at)
                    sets.append(hashes[a:b])
                at += 1
    return table.take(rows), sets


def _verify(n: int, threshold: float):
    def verify(key, table):
        table, sets = _members(table, n)
        reps, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        cut = int(np.searchsorted(table["side"].to_numpy(), 1))
        if key[1].as_py() == key[2].as_py():  # a block with itself
            hit = _matches(sets, sets, threshold)
            np.fill_diagonal(hit, False)
            left = right = reps
            links = hit @ copies
            rows = [reps, links]
        else:
            hit = _matches(sets[:cut], sets[cut:], threshold)
            left, right = reps[:cut], reps[cut:]
            rows = [reps, np.concatenate([hit @ copies[cut:], copies[:cut] @ hit])]
        edges = _forest(hit, left, right)
        found = rows[1] > 0
        return pa.table(
            {
                "src": pa.array([*rows[0][found].tolist(), *(a for a, _ in edges)], pa.int64()),
                "dst": pa.array([None] * int(found.sum()) + [b for _, b in edges], pa.int64()),
                "links": pa.array([*rows[1][found].tolist(), *([0] * len(edges))], pa.int64()),
            }
        )

    return verify


def join(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """doc_id, class_id (least doc_id of the documents it is linked to, directly or through others),
    copy_id (least doc_id with the same n-grams), n_links (documents at the threshold) and n_grams."""
    bands, rows = banding(threshold, recall)
    files = files_for(docs.count(), 50_000)
    sketches = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_sketch(n, bands, rows), "doc_id long, n_grams long, class binary, bands array<long>")
        .groupBy("doc_id")
        .agg(F.min(F.struct("class", "n_grams", "bands")).alias("one"))
    )
    sketches = written(sketches.select("doc_id", "one.*").coalesce(files), "sketches")
    classes = (
        sketches.filter("n_grams > 0")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.min("n_grams").alias("n_grams"),
            F.min_by("bands", "doc_id").alias("bands"),
        )
    )
    classes = written(classes.coalesce(files), "classes")
    keys = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    met = keys.groupBy("band", "key").agg(F.min("rep").alias("dst"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    near = keys.join(met, ["band", "key"]).select(F.col("rep").alias("src"), "dst")
    clusters = components(near).join(
        classes.select(F.col("rep").alias("node"), "class", "copies", "n_grams"), "node"
    )
    sizes = clusters.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n_grams") / _GRAMS)).cast("int").alias("blocks")
    )
    member = clusters.join(sizes, "component").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("node"),
        F.col("text").cast("string").alias("text"),
    )
    placed = (
        member.join(texts, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "component",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
            F.col("node").alias("rep"),
            "class",
            "copies",
            "text",
        )
    )
    verified = written(
        placed.groupBy("component", "low", "high")
        .applyInArrow(_verify(n, threshold), "src long, dst long, links long")
        .repartition(files),
        "verified",
    )
    groups = components(verified.filter("dst IS NOT NULL").select("src", "dst"))
    links = verified.filter("dst IS NULL").groupBy(F.col("src").alias("linked")).agg(F.sum("links").alias("links"))
    described = (
        classes.select("class", "rep", "copies")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .join(links, F.col("rep") == F.col("linked"), "left")
        .select(
            "class",
            F.col("rep").alias("copy_of"),
            F.coalesce("component", "rep").alias("least"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("others"),
        )
    )

    def number(c: str):
        own = F.coalesce(c, "doc_id")
        return F.when(own != NULL_ID, own)

    joined = sketches.join(described, "class", "left").coalesce(files)
    return joined.select(
        number("doc_id").alias("doc_id"),
        number("least").alias("class_id"),
        number("copy_of").alias("copy_id"),
        F.coalesce("others", F.lit(0)).cast("long").alias("n_links"),
        "n_grams",
    )


#: Documents without a number of their own come after all others, by a hash of what they are.
_UNNUMBERED = 1 << 62


def _own_numbers(docs: DataFrame) -> DataFrame:
    """row (all columns), text, doc_id: where doc_id is null or stands for several texts, each text gets a
    number of its own."""
    text = F.col("text").cast("string")
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        text.alias("text"),
        F.col("doc_id").cast("long").alias("number"),
        F.xxhash64("doc_id", F.coalesce(text, F.lit("")), text.isNull()).alias("print"),
    )
    several = (
        packed.groupBy(F.col("number").alias("shared"))
        .agg(F.min("print").alias("low"), F.max("print").alias("high"))
        .filter("shared is null or low <> high")
        .select("shared", F.lit(True).alias("unclear"))
    )
    several = written(several, "shared-numbers")
    own = F.col("print").bitwiseAND(F.lit(_UNNUMBERED - 1)) + F.lit(_UNNUMBERED)
    return packed.join(several, F.col("number").eqNullSafe(F.col("shared")), "left").select(
        "row", "text", F.when(F.col("unclear"), own).otherwise(F.col("number")).alias("doc_id")
    )


def one_of_each(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of each group: its document with the least doc_id. Rows that repeat a doc_id with its text
    are one document; different texts under one doc_id, or under none, are documents of their own, after
    those with a doc_id that is only theirs."""
    numbered = _own_numbers(docs)
    stay = join(numbered.select("doc_id", "text"), n, threshold, recall).filter(F.col("doc_id") == F.col("class_id"))
    stay = stay.select(F.col("doc_id").alias("stays"))
    return (
        numbered.join(stay, F.col("doc_id") == F.col("stays"), "left_semi").dropDuplicates(["doc_id"]).select("row.*")
    )
