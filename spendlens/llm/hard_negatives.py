"""Hard negatives by Kronecker-packed products.

Vectors are integers (floor of a multiple of each component). One component of many candidates is
biased to be nonnegative and laid side by side, a field for each candidate, in one wide integer. An
anchor multiplies each of these integers by its own biased component once and adds the products up;
fields are so wide that no sum reaches the next one, so every field is then an exact inner product
but for terms that the biases add, which are known. Field width follows from the largest components,
so vectors of any magnitude stay exact.

Anchors meet all rows in blocks: rows and anchors are dealt into blocks of bounded size by a hash, and
each pair of blocks is one group. A group returns each anchor's best few, so what travels on is small,
and a window picks the best of those. The first round looks for positives among rows of the anchor's
label; the second for the rows of other labels between the bounds that each positive sets. Labels do not
decide where a row goes, so a hot label is as many tasks' work as any.

Defined results: rows with a null label, a null vector, or a null, NaN or infinite component take no part;
the shorter of two vectors counts as padded with zeros; an empty vector scores 0; a row without vec_id is
no anchor and is relabelled by nothing, but takes part, its id before all others in ties; rows that
repeat a vec_id are rows of their own and each other's positives or negatives; scores beyond 64 bits count
as the largest or least long; anchors without positives, and positives without negatives, return no row;
an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: Bounds of a negative's score, in hundredths of the positive's.
LEAST_PCT, MOST_PCT = 80, 100
#: Rows of a block, and the least for which a block of its own pays.
BLOCK_ROWS, LEAST_ROWS = 16_384, 1_024

_MOST = np.iinfo(np.int64).max


class Packed:
    """Candidates' integer vectors, each component of all candidates in one wide integer.

    `reach` is the largest magnitude of a component of any anchor that will be multiplied."""

    def __init__(self, cells: np.ndarray, reach: int):
        self.size, dims = cells.shape
        self.bias = int(np.abs(cells).max(initial=0))
        self.reach = reach
        bits = (4 * dims * self.bias * reach).bit_length()
        #: bytes of a field; up to 8 its sums fit signed 64-bit arithmetic
        self.width = 4 if bits <= 32 else 8 if bits <= 63 else -(-bits // 8)
        self.sums = cells.sum(axis=1) if self.width <= 8 else cells.astype(object).sum(axis=1)
        self.fields = [self._pack(cells[:, j]) for j in range(dims)]

    def _pack(self, component: np.ndarray) -> int:
        biased = component + self.bias
        if self.width <= 8:
            raw = biased.astype(f"<u{self.width}").tobytes()
        else:
            raw = b"".join(int(v).to_bytes(self.width, "little") for v in biased)
        return int.from_bytes(raw, "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner products with all candidates."""
        biased = [a + self.reach for a in anchor]
        total = sum(a * field for a, field in zip(biased, self.fields, strict=True))
        raw = total.to_bytes(self.size * self.width, "little")
        if self.width <= 8:
            products = np.frombuffer(raw, f"<u{self.width}").astype(np.int64)
        else:
            steps = range(0, len(raw), self.width)
            products = np.array([int.from_bytes(raw[s : s + self.width], "little") for s in steps], dtype=object)
        products = products - self.bias * sum(biased) - self.reach * self.sums
        return products if self.width <= 8 else np.clip(products, -_MOST, _MOST).astype(np.int64)


def _cells(column: pa.ChunkedArray, dims: int, scale: int) -> np.ndarray:
    """Floors of the scaled components, padded with zeros; Python integers where 64 bits do not hold them."""
    column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    whole = np.int64 if np.abs(flat).max(initial=0) < 2.0**53 else object
    cells = np.zeros((len(lengths), dims), dtype=whole)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    cells[np.repeat(np.arange(len(lengths)), lengths), place] = (
        flat.astype(np.int64) if whole is np.int64 else [int(v) for v in flat]
    )
    return cells


def _both(rows: pa.Table, anchors: pa.Table, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The integer vectors of both, as long as the longest."""
    dims = max(pc.max(pc.list_value_length(t["vector"])).as_py() or 0 for t in (rows, anchors))
    return _cells(rows["vector"], dims, scale), _cells(anchors["vector"], dims, scale)


def _best_first(scores: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Candidates by score downwards; ties stay in the candidates' order."""
    return among[np.argsort(-scores[among], kind="stable")]


def _by_id(table: pa.Table) -> pa.Table:
    keys = [("vec_id", "ascending"), ("row", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))


POSITIVE = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long"
NEGATIVE = f"{POSITIVE}, negative_row long, negative_id long, negative_score long"


def _table(found: list[tuple], schema: str) -> pa.Table:
    names = [f.split()[0] for f in schema.split(", ")]
    columns = list(zip(*found, strict=True)) or [()] * len(names)
    return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, columns, strict=True)})


def _find_positives(scale: int, most: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            rows = _by_id(rows)
            cells, wanted = _both(rows, anchors, scale)
            ids, row = rows["vec_id"].to_pylist(), rows["row"].to_numpy()
            label = rows["label"].to_numpy()
            reach = int(np.abs(wanted).max(initial=0))
            packed: dict[int, tuple[np.ndarray, Packed]] = {}
            columns = (anchors[c].to_pylist() for c in ("row", "vec_id", "label"))
            for own, anchor_id, own_label, vector in zip(*columns, wanted.tolist(), strict=True):
                if own_label not in packed:
                    same = np.flatnonzero(label == own_label)
                    packed[own_label] = same, Packed(cells[same], reach)
                same, candidates = packed[own_label]
                if not len(same):
                    continue
                scores = candidates.scores(vector)
                others = np.flatnonzero(row[same] != own)
                for i in _best_first(scores, others)[:most]:
                    at = same[i]
                    found.append((own, anchor_id, int(row[at]), ids[at], int(scores[i])))
        return _table(found, POSITIVE)

    return find


def _find_negatives(scale: int, most: int, least_pct: int, most_pct: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            rows = _by_id(rows)
            cells, wanted = _both(rows, anchors, scale)
            ids, row = rows["vec_id"].to_pylist(), rows["row"].to_numpy()
            label = rows["label"].to_numpy()
            candidates = Packed(cells, int(np.abs(wanted).max(initial=0)))
            columns = (anchors[c].to_pylist() for c in ("row", "vec_id", "label", "positives"))
            for own, anchor_id, own_label, positives, vector in zip(*columns, wanted.tolist(), strict=True):
                # least_pct * p <= 100 * s <= most_pct * p, for whole s
                bounds = [
                    (-(-least_pct * p["positive_score"] // 100), most_pct * p["positive_score"] // 100)
                    for p in positives
                ]
                low = min(b[0] for b in bounds)
                scores = candidates.scores(vector)
                among = _best_first(scores, np.flatnonzero((label != own_label) & (scores >= low)))
                falling = -scores[among]
                for positive, (least, largest) in zip(positives, bounds, strict=True):
                    first = np.searchsorted(falling, -largest)
                    for at in among[first : first + most]:
                        if scores[at] < least:
                            break
                        found.append(
                            (own, anchor_id, *(positive[c] for c in ("positive_row", "positive_id", "positive_score")),
                             int(row[at]), ids[at], int(scores[at]))
                        )
        return _table(found, NEGATIVE)

    return find


def usable(rows: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """row, vec_id, label, vector of the rows that take part, written so that `row` stays what it is."""
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    kept = rows.filter(label.isNotNull() & F.col(vector).isNotNull() & whole)
    return written(
        kept.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(vec_id).cast("long").alias("vec_id"),
            label.cast("long").alias("label"),
            F.col(vector).alias("vector"),
        ),
        "vectors",
    )


def _blocks(rows: int) -> int:
    return max(min(24, -(-rows // LEAST_ROWS)), -(-rows // BLOCK_ROWS), 1)


def _meet(rows: DataFrame, blocks: int, anchors: DataFrame, anchor_blocks: int, find, schema: str) -> DataFrame:
    """Every block of rows with every block of anchors."""

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.lit(own_blocks)).cast("int")
        df = df.select(*(F.col(c).alias(c) for c in df.columns))  # both sides come from one table
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))))

    left = dealt(rows, "block", blocks, "anchor_block", anchor_blocks)
    right = dealt(anchors, "anchor_block", anchor_blocks, "block", blocks)
    key = ["block", "anchor_block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(find, schema)


def _first(df: DataFrame, most: int, per: list[str], kind: str) -> DataFrame:
    """The best few of each group by score, then id (none first), numbered."""
    best = Window.partitionBy(*per).orderBy(
        F.desc(f"{kind}_score"), F.asc_nulls_first(f"{kind}_id"), f"{kind}_row"
    )
    return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_pct: int = LEAST_PCT,
    most_pct: int = MOST_PCT,
) -> DataFrame:
    """Of every anchor (a condition on vec_id) and each of its best positives the best negatives within
    the bounds: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    cells = usable(rows, vec_id, vector, F.col("label") if label is None else label)
    anchors = cells.filter(F.coalesce(is_anchor, F.lit(False)))
    blocks, anchor_blocks = _blocks(cells.count()), -(-anchors.count() // BLOCK_ROWS) or 1

    near = _meet(cells, blocks, anchors, anchor_blocks, _find_positives(scale, positives), POSITIVE)
    near = written(_first(near, positives, ["anchor_row"], "positive").drop("rank"), "positives")

    each = near.groupBy(F.col("anchor_row").alias("row")).agg(
        F.collect_list(F.struct("positive_row", "positive_id", "positive_score")).alias("positives")
    )
    asking = anchors.join(each, "row")
    find = _find_negatives(scale, negatives, least_pct, most_pct)
    hard = _meet(cells, blocks, asking, anchor_blocks, find, NEGATIVE)
    best = _first(hard, negatives, ["anchor_row", "positive_row"], "negative")
    return best.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        "negative_score",
    )


def digest(embeddings: DataFrame) -> DataFrame:
    """The contract's anchors and labels: vec_id divisible by 100; one label in seven is moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings, F.col("vec_id") % 100 == 0, label=moved)


SQL = """
WITH rows AS (
    SELECT row_number() OVER () AS rid, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.rid, a.vec_id AS anchor_id, b.rid AS other, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT)
            AS score
    FROM rows a JOIN rows b ON a.rid <> b.rid
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT rid, anchor_id, other AS positive, other_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, other_id NULLS FIRST, other) <= 5
), negatives AS (
    SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
        row_number() OVER (
            PARTITION BY p.rid, p.positive ORDER BY s.score DESC, s.other_id NULLS FIRST, s.other
        ) AS place
    FROM positives p JOIN scored s ON s.rid = p.rid
    WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 5
"""
