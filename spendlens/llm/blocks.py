"""Documents dealt into blocks by their number, and blocks that exchange sorted arrays.

A block is a bounded lot of whole documents, always the same one however Spark schedules it, so a
later step (or a lost executor's successor) finds the arrays it has sent again in the same order.
Blocks send the parts of a sorted array to whoever is in charge of a key range, one row for a part
that has entries, and get one bit back for each entry. A block sends an entry once, however many of
its documents hold it; so a key that a third of all documents share costs one entry a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import U64, column_bytes, numbers

#: Bytes of text in a block; a longer document is a block's main content by itself.
BLOCK_BYTES = 1 << 20
SENT = "part int, block long, payload binary"
BACK = "block long, round int, part int, payload binary"


@dataclass(frozen=True)
class Dealt:
    docs: DataFrame  # doc_id, text, rest, block
    blocks: int

    @property
    def parts(self) -> int:
        """Key ranges: a few blocks' share of entries each."""
        return max(8, self.blocks // 4)

    def few_files(self, digests: DataFrame) -> DataFrame:
        """Short rows of all documents, dealt anew into files of some 64 blocks' documents each: a file
        for each task of the last step would be tiny, and every file costs its writer a process."""
        return digests.repartition(max(4, self.blocks // 64))


def deal(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> Dealt:
    """Columns besides doc_id and text travel in `rest`, whatever their names are."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(16, -(-total // block_bytes))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    return Dealt(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
            rest.alias("rest"),
            F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(blocks)).alias("block"),
        ).repartition(max(12, blocks // 16), "block"),
        blocks,
    )


#: Texts, and code points of each, that steer where key ranges are cut.
SAMPLED = 4_000


def sampled_texts(docs: DataFrame) -> list[str]:
    """A bounded sample of pieces of texts, by hashes of doc_id. Only balance follows from it."""
    rows = docs.count()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    start = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.lit(1), F.char_length(text) - SAMPLED)) + 1
    some = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(max(1, rows // (SAMPLED // 2)))) == 0)
    pieces = some.select(F.substring(text, start.cast("int"), F.lit(SAMPLED)).alias("t")).limit(SAMPLED)
    return [r["t"] for r in pieces.collect()]


def ordered(table: pa.Table) -> pa.Table:
    """By document number, nulls first; rows with one number by their text."""
    order = pc.sort_indices(
        table.select(["doc_id", "text"]),
        sort_keys=[("doc_id", "ascending"), ("text", "ascending")],
        null_placement="at_start",
    )
    return table.take(order)


def contents(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = column_bytes(table["text"])
    return numbers(table["doc_id"]), data, offsets


def shares(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's range of sorted 64-bit keys begins, and the end."""
    part = ((keys >> U64(32)) * U64(parts)) >> U64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=U64))


def sent(block: int, cuts: np.ndarray, payload: Callable[[int, int], bytes]) -> pa.Table:
    parts = np.flatnonzero(np.diff(cuts))
    return pa.table(
        {
            "part": pa.array(parts, pa.int32()),
            "block": pa.array(np.full(len(parts), block), pa.int64()),
            "payload": pa.array([payload(cuts[p], cuts[p + 1]) for p in parts], pa.binary()),
        }
    )


def answered(round_no: int, part: int, blocks: list[int], marks: Iterator[np.ndarray]) -> pa.Table:
    return pa.table(
        {
            "block": pa.array(blocks, pa.int64()),
            "round": pa.array([round_no] * len(blocks), pa.int32()),
            "part": pa.array([part] * len(blocks), pa.int32()),
            "payload": pa.array([np.packbits(m).tobytes() for m in marks], pa.binary()),
        }
    )


def marks(answers: pa.Table, round_no: int, cuts: np.ndarray) -> np.ndarray:
    """The bits that came back for the entries a block has sent."""
    out = np.zeros(cuts[-1], dtype=bool)
    for n, part, payload in zip(
        answers["round"].to_pylist(), answers["part"].to_pylist(), answers["payload"].to_pylist(), strict=True
    ):
        if n == round_no:
            size = cuts[part + 1] - cuts[part]
            out[cuts[part] : cuts[part + 1]] = np.unpackbits(np.frombuffer(payload, np.uint8), count=size).astype(bool)
    return out


def two_rounds(dealt: Dealt, first, meet_first, second, meet_second, finish, result: T.StructType) -> DataFrame:
    """Send, answer, send what the answers leave, answer, finish.

    The dealt texts are one exchange that all three steps read. `first(key, texts)`,
    `second(key, texts, answers)` and `finish(key, texts, answers)` get a block; the `meet`
    functions get a part's rows of all blocks.
    """
    texts = dealt.docs
    one = texts.groupBy("block").applyInArrow(first, SENT).groupBy("part").applyInArrow(meet_first, BACK)
    two = (
        texts.groupBy("block")
        .cogroup(one.groupBy("block"))
        .applyInArrow(second, SENT)
        .groupBy("part")
        .applyInArrow(meet_second, BACK)
    )
    return texts.groupBy("block").cogroup(one.union(two).groupBy("block")).applyInArrow(finish, result)


def with_columns(dealt: Dealt, more: str) -> T.StructType:
    """The schema of the dealt documents without their block, and further columns."""
    kept = [f for f in dealt.docs.schema.fields if f.name != "block"]
    return T.StructType(kept + T._parse_datatype_string(more).fields)


def unpacked(found: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The columns of `docs` in their order, with the found text, and further columns."""
    own = [F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return found.select(*own, *more)
