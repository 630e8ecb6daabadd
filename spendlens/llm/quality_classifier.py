"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its units: each word, the character n-grams of the word
between marks for its begin and end, and each pair of neighbouring words; a word that repeats the one
before it makes one unit of its own, whatever the word is. Units are hashed into a table of vectors. A
softmax layer reads the average. Vectors and layer are trained together by stochastic gradient descent in
numpy, one labelled text at a time, with a falling rate.

The model is fitted on at most TRAINED texts with at most TRAINED_UNITS units (documented bounds: labelled
documents in order of hashes of their doc_id), in one task; all documents are scored, each whole. As the
layer is linear, a unit's vector counts only through its product with the layer: what the tasks get is one
pair of logits for each bucket, a table of a fixed size. A text is cut into words and units a bounded piece
at a time, and the n-grams of a word are made once for a piece, however often it holds the word.

Learning: documents with crc32(doc_id as text) mod 4 equal to 2 are held out; labels of others teach. Only
the text is read for a score.

Defined results: a null or empty text has no units and scores what the layer says without any; a null
doc_id counts as empty text in crc32 and has no label; a doc_id with several labels teaches with the
greatest, one with several texts with the least text; labels other than 0 and 1 teach nothing; without any
label that teaches every score is 0.5; rows that repeat a doc_id are scored each by its text; an empty
table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import written
from .text import SPACES, U64, Rolling, Words, column_bytes, cut, lots, mixed

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Labelled texts that the model is fitted on, at most, and the most buckets that they can touch in all.
TRAINED, TRAINED_UNITS = 6_000, 24_000_000
BUCKETS = 1 << 17
DIMS = 16
GRAMS = (3, 4, 5)
EPOCHS, RATE = 6, 4.0
SEED = 20_240_117
#: Bytes of text that are cut into units at once.
PIECE = 1 << 19

_BYTES = np.arange(256, dtype=U64)
_GRAM_LETTERS = mixed((_BYTES + U64(1)) * U64(0x9E3779B97F4A7C15) + U64(5))
_REPEATED = U64(0x5851F42D4C957F2D)
_BEGIN, _END = 2, 3  # control bytes as marks of a word's ends


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes & U64(buckets - 1)).astype(np.int64)


def _grams(words: Words, some: np.ndarray, sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of some words, and which of the words each belongs to."""
    lengths = words.ends[some] - words.starts[some]
    firsts = np.cumsum(lengths + 2) - (lengths + 2)
    total = int((lengths + 2).sum())
    place = np.arange(total) - np.repeat(firsts, lengths + 2)
    marked = np.full(total, _BEGIN, dtype=np.uint8)
    inside = (place > 0) & (place <= np.repeat(lengths, lengths + 2))
    marked[inside] = words.data[(np.repeat(words.starts[some], lengths + 2) + place - 1)[inside]]
    marked[firsts + lengths + 1] = _END
    # characters begin at every byte that continues none
    chars = np.flatnonzero((marked & 0xC0) != 0x80)
    owner = np.searchsorted(firsts, chars, side="right") - 1
    ends = np.append(chars, total)
    roll = Rolling(_GRAM_LETTERS[marked])
    found, whose = [], []
    for n in sizes:
        whole = np.flatnonzero(owner[: len(chars) - n + 1] == owner[n - 1 :]) if len(chars) >= n else np.zeros(0, int)
        found.append(_bucket(mixed(roll.runs(chars[whole], ends[whole + n]) + U64(n)), buckets))
        whose.append(owner[whole])
    return np.concatenate(found), np.concatenate(whose)


class Units:
    """The units of a run of texts: words that occur, their n-grams, and pairs of neighbours."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sizes=GRAMS, buckets: int = BUCKETS):
        words = Words(data, offsets)
        hashes = words.hashes()
        known, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.owner = words.owner
        grams, whose = _grams(words, first, sizes, buckets)
        #: buckets of each known word and its n-grams, one after the other by word
        order = np.argsort(whose, kind="stable")
        self.per_word = 1 + np.bincount(whose, minlength=len(known))
        self.starts = np.cumsum(self.per_word) - self.per_word
        self.buckets = np.empty(int(self.per_word.sum()), dtype=np.int64)
        own = np.zeros(len(self.buckets), dtype=bool)
        own[self.starts] = True
        self.buckets[own] = _bucket(known, buckets)
        self.buckets[~own] = grams[order]
        after = np.flatnonzero(self.owner[1:] == self.owner[:-1])
        left, right = hashes[after], hashes[after + 1]
        pairs = np.where(left == right, _REPEATED, mixed(left * U64(3) + mixed(right)))
        self.pairs, self.pair_owner = _bucket(pairs, buckets), self.owner[after]

    def sums(self, logits: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each text the summed logits of its units, and how many units it has."""
        out = np.zeros((texts, logits.shape[1]))
        many = np.bincount(self.pair_owner, minlength=texts).astype(np.float64)
        if len(self.buckets):
            many += np.bincount(self.owner, self.per_word[self.word], texts)
        for c in range(logits.shape[1]):
            if len(self.buckets):
                of_word = np.add.reduceat(logits[self.buckets, c], self.starts)
                out[:, c] = np.bincount(self.owner, of_word[self.word], texts)
            out[:, c] += np.bincount(self.pair_owner, logits[self.pairs, c], texts)
        return out, many

    def counts(self, buckets: int) -> np.ndarray:
        """How often the run's units fall into each bucket."""
        times = np.bincount(self.word, minlength=len(self.per_word))
        return np.bincount(self.buckets, np.repeat(times, self.per_word), buckets) + np.bincount(
            self.pairs, minlength=buckets
        )


def text_units(data: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a text's units fall into, and the share of its units in each."""
    counts = np.zeros(buckets)
    for piece, offsets, _ in lots(data, np.array([0, len(data)]), PIECE, SPACES):
        counts += Units(piece, offsets, buckets=buckets).counts(buckets)
    some = np.flatnonzero(counts)
    return some, (counts[some] / max(1.0, counts.sum())).astype(np.float32)


def train(
    texts: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    buckets: int = BUCKETS,
    dims: int = DIMS,
    epochs: int = EPOCHS,
    rate: float = RATE,
) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times layer (buckets x 2) and the layer's constant (2), by stochastic gradient descent."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / dims, 1 / dims, (buckets, dims)).astype(np.float32)
    layer, constant = np.zeros((dims, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = epochs * len(texts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            at, shares = texts[i]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            own = vectors[at]
            average = shares @ own
            logits = average @ layer + constant
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = layer @ error
            layer -= step * np.outer(average, error)
            constant -= step * np.float32(0.1) * error
            vectors[at] = own - step * shares[:, None] * back
    return vectors @ layer, constant


def probabilities(data: np.ndarray, offsets: np.ndarray, logits: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """The probability of label 1 of each text."""
    texts = len(offsets) - 1
    sums, many = np.zeros((texts, 2)), np.zeros(texts)
    for piece, own_offsets, whose in lots(data, offsets, PIECE, SPACES):
        more, units = Units(piece, own_offsets, buckets=len(logits)).sums(logits, len(whose))
        sums[whose] += more
        many[whose] += units
    average = sums / np.maximum(many, 1)[:, None] + constant
    return 1 / (1 + np.exp(average[:, 0] - average[:, 1]))


# ------------------------------------------------------------------ on Spark


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _taught(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text, label of the labelled documents that are not held out, those with the least hashes."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    label = F.col("quality").cast("int")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.alias("label")).filter(
        label.isin(0, 1) & F.col("doc_id").isNotNull() & (_fold(F.col("doc_id")) != HELD_OUT)
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    here = known.join(own.select("doc_id"), "doc_id", "left_semi")
    # ids and labels only, at most `most` short rows; their texts are looked up in all documents
    some = here.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    met = own.join(F.broadcast(spark.createDataFrame(some, "doc_id long, label int").coalesce(1)), "doc_id")
    met = written(met.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled")
    size = F.least(F.coalesce(F.octet_length("text"), F.lit(0)), F.lit(BUCKETS))
    sizes = {r["doc_id"]: r["size"] for r in met.select("doc_id", size.alias("size")).collect()}
    units = np.cumsum([sizes[r["doc_id"]] for r in some])
    kept = [(r["doc_id"],) for r, held in zip(some, units, strict=True) if held <= TRAINED_UNITS]
    return met.join(F.broadcast(spark.createDataFrame(kept, "doc_id long").coalesce(1)), "doc_id")


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        data, offsets = column_bytes(batch["text"])
        for i, (doc_id, label) in enumerate(zip(batch["doc_id"].to_pylist(), batch["label"].to_pylist(), strict=True)):
            rows.append((doc_id, label, text_units(data[offsets[i] : offsets[i + 1]])))
    if rows:
        rows.sort(key=lambda r: r[0])  # however the texts arrive, one model
        logits, constant = train([r[2] for r in rows], np.array([r[1] for r in rows]))
        names = ["logits", "constant"]
        values = [logits.astype("<f4").tobytes(), constant.astype("<f4").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=names)


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINED) -> tuple[np.ndarray, np.ndarray]:
    """The model, fitted in one task on at most `most` texts."""
    taught = _taught(docs, labels, most).coalesce(1)
    row = written(taught.mapInArrow(_fitted, "logits binary, constant binary"), "quality-model").first()
    if row is None:
        return np.zeros((1, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    return np.frombuffer(row["logits"], "<f4").reshape(-1, 2), np.frombuffer(row["constant"], "<f4")


def _scored(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logits, constant = model.value
        for whole in batches:
            for batch in cut(whole, 4 * PIECE):
                found = probabilities(*column_bytes(batch["text"]), logits, constant)
                names = [n for n in batch.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[n] for n in names), pa.array(found, pa.float64())], names=[*names, "score"]
                )

    return score


def classify(docs: DataFrame, labels: DataFrame, most: int = TRAINED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))
    rows = docs.select(
        F.col("doc_id"), (_fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_scored(model), f"doc_id {doc_id}, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, labels)
