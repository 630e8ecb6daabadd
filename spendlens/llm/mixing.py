"""Mixing sources to target weights, by pivotal dependent rounding of copy counts.

Sources in code point order (null last) weigh 5, 2, 1, repeating. They share a fixed multiple of all
words by weight, but none gets more than twice its size; what is above is shared again, which ends at
one level: target = min(level * weight, 2 * size). Every document of a source starts with the copy
count target / size. Its whole part is taken as it is; the fractions are rounded in pairs: words move
between two documents, in a random direction that leaves both expectations as they are, until one of
them has no copy or a whole one. So a source's words never change, but for the one fraction that is
left at the very end, which goes to the nearer side.

Pairs are formed inside hash buckets of each source, so a hot source is many tasks' work; each bucket
leaves one document, and those meet in buckets of buckets up a tree. Draws come from hashes of the
doc_id, and orders are fixed, so reruns agree.

Defined results: a null, empty or blank text has size 0 and takes 0 words; a null source is a source;
rows that repeat a doc_id are documents of their own; an empty table gives an empty result; further
columns do not matter. Each source's target and rank come from one row per source, in one window.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import files_for, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20_240_117
#: Documents of a first bucket, and buckets that meet in one of the next level.
BUCKET, FAN = 1_000, 64


def sizes(docs: DataFrame) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id"), F.col("source"), words.cast("long").alias("size"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, documents and target."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    # in order of the level at which a source's cap is met: the level that the sources from here on
    # can share once those before have their caps
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", level)
    fits = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))
    per = per.withColumn("common", F.max(fits).over(everything))
    target = F.least(F.coalesce(F.col("common") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return per.select("source", "source_size", "documents", target.cast("double").alias("target"))


_MASS = "doc_id long, source string, size long, source_size long, target double, whole long, bucket long, buckets long, words double, open boolean"


def _moved(giver: float, taker: float, most: int) -> tuple[float, float]:
    """The two after the giver has nothing or the taker has a whole copy, whichever comes first."""
    room = most - taker
    return (0.0, taker + giver if giver < room else float(most)) if giver <= room else (giver - room, float(most))


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of source and bucket: each pairs with what its bucket has left so far."""
    key = left = None
    for batch in batches:
        columns = {n: batch[n].to_pylist() for n in ("source", "bucket", "size", "words", "draw")}
        rows = batch.select(batch.schema.names[:-1])
        done: list[tuple[pa.RecordBatch, int, float, bool]] = []
        for i, (source, bucket, size, words, draw) in enumerate(zip(*columns.values(), strict=True)):
            if (source, bucket) != key:
                if left:
                    done.append((*left[:2], left[3], True))
                key, left = (source, bucket), None
            if not 0 < words < size:
                done.append((rows, i, words, False))
                continue
            if left is None:
                left = (rows, i, size, words)
                continue
            kept, at, other, has = left
            give, take = min(has, size - words), min(words, other - has)
            if draw * (give + take) < take:  # to this one, with the chance that leaves both means
                has, words = _moved(has, words, size)
            else:
                words, has = _moved(words, has, other)
            if 0 < has < other:
                done.append((rows, i, words, False))
                left = (kept, at, other, has)
            else:
                done.append((kept, at, has, False))
                left = (rows, i, size, words) if 0 < words < size else None
                if left is None:
                    done.append((rows, i, words, False))
        if done:
            yield _settled(done)
    if left:
        yield _settled([(*left[:2], left[3], True)])


def _settled(done) -> pa.RecordBatch:
    parts: dict[int, tuple[pa.RecordBatch, list[int], list[float], list[bool]]] = {}
    for rows, i, words, is_open in done:
        part = parts.setdefault(id(rows), (rows, [], [], []))
        for kept, new in zip(part[1:], (i, words, is_open), strict=True):
            kept.append(new)
    tables = []
    for rows, at, words, is_open in parts.values():
        t = pa.Table.from_batches([rows]).take(pa.array(at, pa.int64()))
        t = t.set_column(t.schema.get_field_index("words"), "words", pa.array(words, pa.float64()))
        tables.append(t.set_column(t.schema.get_field_index("open"), "open", pa.array(is_open, pa.bool_())))
    return pa.concat_tables(tables).combine_chunks().to_batches()[0]


def _draw(level: int) -> Column:
    """Uniform in [0, 1) from the doc_id and the level."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED), F.lit(level)), 11) / float(1 << 53)


def _round(level: int, rows: DataFrame) -> DataFrame:
    placed = rows.withColumn("draw", _draw(level)).repartition("source", "bucket")
    return placed.sortWithinPartitions("source", "bucket", F.desc("size"), "draw", "doc_id").mapInArrow(_pair, _MASS)


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, bucket: int = BUCKET, fan: int = FAN
) -> DataFrame:
    """doc_id, size, source_size, target (of the source), copies and taken (words)."""
    sized = written(
        sizes(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "size"),
        "sizes",
    )
    per = targets(sized, weights, share, most).withColumnRenamed("source", "of")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        sized.join(per, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("whole", F.floor(copies).cast("long"))
        .withColumn("buckets", F.ceil(F.col("documents") / bucket).cast("long"))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "whole",
            F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.col("buckets")).alias("bucket"),
            "buckets",
            ((copies - F.col("whole")) * F.col("size")).alias("words"),
            F.lit(True).alias("open"),
        )
    )
    level, closed, files = 0, [], files_for(sized.count(), 50_000)
    now = written(_round(level, rows).coalesce(files), "mix")
    while (now.filter("open").agg(F.max("buckets")).first()[0] or 1) > 1:
        closed.append(now.filter("NOT open"))
        level += 1
        up = now.filter("open").withColumn("bucket", F.floor(F.col("bucket") / fan).cast("long"))
        up = up.withColumn("buckets", F.ceil(F.col("buckets") / fan).cast("long"))
        now = written(_round(level, up).coalesce(files), "mix")
    all_rows = reduce(DataFrame.union, [*closed, now])
    n = F.col("whole") + F.when(F.col("words") * 2 >= F.col("size"), 1).otherwise(0)
    n = F.when(F.col("size") > 0, n).otherwise(0).cast("long")
    return all_rows.coalesce(files).select(
        "doc_id", "size", "source_size", "target", n.alias("copies"), (n * F.col("size")).alias("taken")
    )


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
