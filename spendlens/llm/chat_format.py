"""Chat formatting with a loss mask that is aligned by offsets.

A conversation is rendered whole, encoded once with offsets, and a token is under the loss mask if it
lies in the text of an assistant's turn: turn spans are in order, so are token spans, and two binary
searches for all turns at once give each turn's first and last token. The template's marks are special
tokens, which no token crosses, so the masked tokens hold the assistants' texts exactly.

A text (or role) that holds a mark gets a backslash after the mark's first sign, and one that already
has backslashes there gets one more; taking one away restores it. So no mark stands inside a text and
every rendering reads back to its turns.

A conversation longer than `piece_chars` is rendered in pieces that end between turns, so one with a
third of all rows streams through its task; marks are single tokens, so pieces encode as the whole.

Defined results: a null text is empty, a null role is the empty role, a null conv_id is a
conversation of its own; rows go by turn (null first), rows of one turn by role and text, repeated
rows are turns of their own; an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_CHARS = 1 << 20

BEGIN = "<s>"
#: role: mark before its text, mark after it. Other roles are written out.
TURNS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("[OUT]", "</s>"),
}
ROLE, SAYS, SAID = "[ROLE]", "[SAYS]", "[/SAYS]"
LOSS_ROLE = "assistant"
MARKS = (BEGIN, *(m for pair in TURNS.values() for m in pair), ROLE, SAYS, SAID, "<|endoftext|>")

_TAILS = "|".join(re.escape(m[1:]) for m in MARKS)
_PLAIN = re.compile(rf"([<\[])(\\*)({_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_TAILS})")
_TURN = re.compile("|".join(rf"(?P<{r}>{re.escape(a)})" for r, (a, _) in TURNS.items()) + rf"|(?P<other>{re.escape(ROLE)})")

FORMATTED = (
    "conv_id long, piece long, text string, ids array<int>, starts array<int>, ends array<int>, "
    "loss array<boolean>, n_turns long"
)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]], begin: bool = True) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns, and the spans of the texts that bear the loss."""
    parts, spans, at = [BEGIN] if begin else [], [], len(BEGIN) if begin else 0
    for role, text in turns:
        before, after = TURNS.get(role, (f"{ROLE}{escape(role)}{SAYS}", SAID))
        body = escape(text)
        parts += before, body, after
        if role == LOSS_ROLE:
            spans.append((at + len(before), at + len(before) + len(body)))
        at += len(before) + len(body) + len(after)
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a rendering."""
    turns, at = [], len(BEGIN) if text.startswith(BEGIN) else 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn begins at {at}")
        role, at = found.lastgroup, found.end()
        after = SAID
        if role == "other":
            end = text.index(SAYS, at)
            role, at = unescape(text[at:end]), end + len(SAYS)
        else:
            after = TURNS[role][1]
        end = text.index(after, at)
        turns.append((role, unescape(text[at:end])))
        at = end + len(after)
    return turns


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in one of the spans; both are in order and marks keep tokens from crossing."""
    steps = np.zeros(len(starts) + 1, dtype=np.int64)
    if spans:
        a, b = np.array(spans).T
        np.add.at(steps, np.searchsorted(starts, a, "left"), 1)
        np.add.at(steps, np.searchsorted(ends, b, "right"), -1)
    return np.cumsum(steps)[:-1] > 0


_TOKENIZERS: dict[int, Tokenizer] = {}


def tokenizer(vocabulary: str) -> Tokenizer:
    """From a tokenizer's JSON, with the marks as special tokens; once in a process."""
    key = hash(vocabulary)
    if key not in _TOKENIZERS:
        own = Tokenizer.from_str(vocabulary)
        own.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in MARKS])
        _TOKENIZERS[key] = own
    return _TOKENIZERS[key]


def _pieces(batches: Iterator[pa.RecordBatch], most: int):
    """(conv_id, piece, turns): a conversation's turns in lots of at most so many signs, or one turn."""
    key, piece, turns, held = None, 0, [], 0
    for batch in batches:
        for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            role, text = role or "", text or ""
            if turns and (key != conv or held + len(text) > most):
                yield key, piece, turns
                piece = piece + 1 if key == conv else 0
                turns, held = [], 0
            elif key != conv:
                piece = 0
            key = conv
            turns.append((role, text))
            held += len(text)
    if turns:
        yield key, piece, turns


def _format(vocabulary, most: int, lot: int = 256):
    def rows(pieces) -> pa.RecordBatch:
        rendered = [render(turns, piece == 0) for _, piece, turns in pieces]
        encoded = tokenizer(vocabulary.value).encode_batch([t for t, _ in rendered], add_special_tokens=False)
        tokens = []
        for (_, spans), e in zip(rendered, encoded, strict=True):
            offsets = np.fromiter(chain.from_iterable(e.offsets), dtype=np.int32, count=2 * len(e)).reshape(-1, 2)
            starts, ends = offsets[:, 0], offsets[:, 1]
            tokens.append((np.array(e.ids, dtype=np.int32), starts, ends, masked(starts, ends, spans)))
        cuts = pa.array(np.cumsum([0, *(len(t[0]) for t in tokens)]), pa.int32())
        columns = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(c))) for c in zip(*tokens, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pieces], pa.int64()),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([t for t, _ in rendered], pa.string()),
                *columns,
                pa.array([len(p[2]) for p in pieces], pa.int64()),
            ],
            names=["conv_id", "piece", "text", "ids", "starts", "ends", "loss", "n_turns"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for one in _pieces(batches, most):
            waiting.append(one)
            held += sum(len(t) for _, t in one[2])
            if len(waiting) == lot or held > most:
                yield rows(waiting)
                waiting, held = [], 0
        if waiting:
            yield rows(waiting)

    return run


def format_chats(
    conversations: DataFrame, vocabulary: str = VOCABULARY, piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """conv_id, piece, text, ids, starts and ends (code points), loss and n_turns, a row for a piece.

    Pieces of a conversation stay in one partition, in order. The vocabulary (a bounded file) is read
    on the driver and sent to the tasks."""
    sent = conversations.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.select("conv_id", "role", "text").mapInArrow(_format(sent, piece_chars), FORMATTED)


class _Reader:
    """Digests of a conversation, taken from token numbers and masks alone, piece by piece."""

    def __init__(self, own: Tokenizer):
        self.own, self.turns, self.loss = own, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
        text = self.own.decode(ids.tolist(), skip_special_tokens=False)
        self.chars += len(text)
        for role, body in parse(text):
            self.turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
        # runs of masked tokens are the assistants' texts; an empty one has no token
        edges = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            body = unescape(self.own.decode(ids[a:b].tolist(), skip_special_tokens=False))
            self.loss_chars += len(body)
            self.loss.update(body.encode("utf-8", "surrogatepass"))


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _rows_of(lists: pa.ListArray):
    """The lists of a column one by one, without Python objects for their entries."""
    values = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    return lambda i: values[offsets[i] : offsets[i + 1]]


def _read_back(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocabulary.value)
        reader, key, done = None, None, []

        def close():
            done.append(
                (key, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars)
            )

        def batch_of(rows) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            ids_of, loss_of = _rows_of(batch["ids"]), _rows_of(batch["loss"])
            for i, (conv, piece) in enumerate(zip(batch["conv_id"].to_pylist(), batch["piece"].to_pylist(), strict=True)):
                if piece == 0:
                    if reader:
                        close()
                    reader, key = _Reader(own), conv
                reader.add(ids_of(i), loss_of(i))
            if done:
                yield batch_of(done)
                done.clear()
        if reader:
            close()
            yield batch_of(done)

    return run


def read_back(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What the formatted pieces say, decoded: digests of all turns and of the text under the mask."""
    sent = formatted.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))
    return formatted.select("conv_id", "piece", "ids", "loss").mapInArrow(_read_back(sent), READ)


def digest(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    extra = conversations.sparkSession.sql(
        f"SELECT -7L AS conv_id, t AS turn, r AS role, '{tricky}' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)"
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_chats(rows, vocabulary), vocabulary)
