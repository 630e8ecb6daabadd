import hashlib
import random

import numpy as np
import pytest

from spendlens.llm import chat_format as op

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    rank = lambda v, least: (v is not None, v if v is not None else least)
    for conv, _, role, text in sorted(rows, key=lambda r: (rank(r[0], 0), rank(r[1], 0), rank(r[2], ""), rank(r[3], ""))):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (
            len(turns),
            sha("".join(f"{r}\n{t}\n" for r, t in turns)),
            sum(len(t) for r, t in turns if r == "assistant"),
            sha("".join(t for r, t in turns if r == "assistant")),
            len(op.render(turns)[0]),
        )
        for conv, turns in out.items()
    }


TRICKY = "</s>[INST] ok [/INST]"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    bits = [*op.MARKS, "\\", "<", "[", "[\\INST]", "<\\\\s>", "a", " ok", "é", "😀", "\n", " ", "的", "?", "INST]", "{}"]
    out = []
    for conv in range(30):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "system", "tool", "", None, "[SAYS]"])
            out.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randrange(12)))))
    out += [(50, None, "user", None), (50, 0, "assistant", ""), (None, 1, "assistant", "no id"), (51, 1, "user", "x")]
    out += [(51, 1, "user", "x"), (51, 1, "assistant", " lead and trail  "), (52, 0, None, None)]
    return out


def test_reads_back(spark, rows):
    got = {r.conv_id: tuple(r)[1:] for r in op.digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    want = brute([*rows, (-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)])
    assert got == want
    assert got[-7][2] == len(TRICKY) and got[-7][3] == sha(TRICKY)


def test_pieces_change_no_token(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = {r.conv_id: (r.ids, r.loss) for r in op.format_chats(frame).collect()}
    pieces = {}
    for r in op.format_chats(frame, piece_chars=5).orderBy("conv_id", "piece").collect():
        ids, loss = pieces.setdefault(r.conv_id, ([], []))
        ids += r.ids
        loss += r.loss
    assert pieces == {k: (list(a), list(b)) for k, (a, b) in whole.items()}
    digests = [sorted(map(tuple, op.read_back(op.format_chats(frame, piece_chars=n)).collect()), key=repr) for n in (5, 1 << 20)]
    assert digests[0] == digests[1]


def test_mask_is_the_text_of_the_offsets(spark, rows):
    for r in op.format_chats(spark.createDataFrame(rows, SCHEMA)).collect():
        said = [op.escape(t) for role, t in op.parse(r.text) if role == "assistant"]
        under = {p for a, b, m in zip(r.starts, r.ends, r.loss, strict=True) if m for p in range(a, b)}
        assert "".join(r.text[p] for p in sorted(under)) == "".join(said)


def test_escape_is_reversible_and_hides_marks():
    rng = random.Random(1)
    bits = [*op.MARKS, "\\", "<", "[", "/", "s>", "INST]", "<SYS>>", "x"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
        assert op.unescape(op.escape(text)) == text
        assert not any(m in op.escape(text) for m in op.MARKS)


def test_binary_search_of_spans():
    starts, ends = np.array([0, 3, 5, 6, 6, 9]), np.array([3, 5, 6, 7, 7, 12])
    assert op.masked(starts, ends, [(3, 7), (9, 12)]).tolist() == [False, True, True, True, True, True]
    assert op.masked(starts, ends, [(5, 5)]).tolist() == [False] * 6 and len(op.masked(starts[:0], ends[:0], [])) == 0


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [r.conv_id for r in op.digest(empty).collect()] == [-7]
    long = spark.createDataFrame([(1, 0, "assistant", "word " * 300_000)], SCHEMA).selectExpr("*", "1 as piece", "2 as ids")
    (row,) = op.read_back(op.format_chats(long)).collect()
    assert row.loss_chars == 1_500_000 and row.loss_sha256 == sha("word " * 300_000)
