import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from spendlens.llm import lm_score as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def brute(rows):
    tokens = [[*WORD.findall(lower(t)), None] for _, t in rows]
    seen = Counter(w for (i, _), own in zip(rows, tokens, strict=True) if fold(i) != 2 for w in own)
    n, v = sum(seen.values()), len(seen)
    return sorted(
        (
            (i, fold(i) == 2, len(own), sum(seen[w] > 0 for w in own), n, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own))
            for (i, _), own in zip(rows, tokens, strict=True)
        ),
        key=repr,
    )


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    syllables = ["the", "on", "er", "ing", "th", "an", "ü", "的", "re"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    out = []
    for i in range(220):
        own = [rng.choice(words[: 20 if rng.random() < 0.5 else 300]) for _ in range(rng.randrange(150))]
        own = ["".join(rng.choice(syllables) for _ in range(4)) if rng.random() < 0.02 else w for w in own]
        out.append((i, "".join(w.capitalize() + rng.choice([" "] * 400 + ["\n", " \t"]) for w in own)))
    long = "x" * 100
    return [*out, (300, None), (301, ""), (302, "  \n "), (303, f" {long} {long}y {long} the"), (None, "the the"), (5, "the"), (304, "the\x00 the")]


@pytest.fixture(scope="module")
def scored(docs, rows):
    return op.digest(docs(*rows)).collect()


def test_base_equals_brute_force(rows, scored):
    got = sorted((tuple(r)[:6] for r in scored), key=repr)
    for a, b in zip(got, brute(rows), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-12)


def test_held_out_accuracy(rows, scored):
    """Far below the entropy of single bytes; and no worse than the word model where it knows all words,
    though it also predicts the blanks."""
    texts = {i: lower(t).encode() for i, t in rows}
    held = [r for r in scored if r.held_out and r.n_tokens > 20]
    assert len(held) > 10
    seen = Counter(b for r in held for b in texts[r.doc_id])
    n = sum(seen.values())
    bytes_alone = sum(c * math.log10(c / n) for c in seen.values())
    assert sum(r.score for r in held) > 0.6 * bytes_alone
    known = [r for r in held if r.n_known == r.n_tokens]
    assert known and sum(r.score for r in known) > 1.02 * sum(r.base_score for r in known)
    assert all(r.score < 0 for r in held) and [r.score for r in scored if r.doc_id in (300, 301)] == [0, 0]


def test_model_beats_the_base_on_given_documents(spark):
    out = op.digest(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    known = [r for r in out if r.n_known == r.n_tokens]
    assert known and sum(r.score for r in known) > sum(r.base_score for r in known)


def test_scores_do_not_follow_partitions(docs, rows, scored):
    again = op.digest(docs(*rows, parts=7)).collect()
    a, b = (sorted(((repr(r.doc_id), r.n_tokens, r.score) for r in x)) for x in (scored, again))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert np.allclose([x[2] for x in a], [x[2] for x in b], rtol=1e-3)


def test_probabilities_of_all_next_bytes_sum_to_one(docs, rows):
    model, *_ = op.train(docs(*rows))
    for start in (b"", b"th", b"zq", b"theoning"):
        cells = np.zeros((256, op.WIDTH), dtype=np.uint8)
        cells[:, : len(start)] = np.frombuffer(start, np.uint8)
        cells[:, len(start)] = np.arange(256)
        size = np.full(256, len(start) + 1)
        before = model.score(cells[:1], size[:1] - 1)[0]
        assert sum(10 ** (model.score(cells, size) - before)) == pytest.approx(1, abs=1e-6)


def test_bytes_before_a_unit_count(docs):
    """Two texts of the same units, none twice: the one in the order of the training documents is likelier."""
    rng = random.Random(7)
    ends = {"ka": "zo", "le": "fi", "mu": "ri"}  # how a word ends, and how the next one begins

    def chain(n):
        begin, words = "zo", []
        for _ in range(n):
            end = rng.choice(sorted(ends))
            words.append(begin + "".join(rng.choice("bdgnt") + rng.choice("aeiou") for _ in range(3)) + end)
            begin = ends[end]
        return words

    ids = [i for i in range(2000) if fold(i) != 2][:600]
    held = [i for i in range(2000) if fold(i) == 2][:2]
    own = list(dict.fromkeys(chain(60)))
    back = [own[0], *own[:0:-1]]
    rows = [*((i, " ".join(chain(60)) + " ") for i in ids), (held[0], " ".join(own) + " "), (held[1], " ".join(back) + " ")]
    score = {r.doc_id: r.score for r in op.digest(docs(*rows)).collect()}
    assert score[held[0]] > score[held[1]] + 5


def test_probabilities_after_other_bytes_sum_to_one(docs, rows):
    model, *_ = op.train(docs(*rows))
    data, offsets = op._lowered(op.pa.array(["on the"]))
    u = op._Units(data, offsets)
    before = np.repeat(u.before()[1:], 256)
    assert [int(x) for x in u.before()] == [0, (3 << 32) | int.from_bytes(b"on ", "big")]
    cells = np.zeros((256, op.WIDTH), dtype=np.uint8)
    cells[:, 0] = np.arange(256)
    assert sum(10 ** model.score(cells, np.ones(256, dtype=np.int64), before)) == pytest.approx(1, abs=1e-6)
    # the first bytes where a unit occurs and the others together are the whole unit
    whole = model.score(u.cells, u.size, u.before()[np.argsort(u.which)])[u.which]
    inside = model.score(u.cells, u.size, None, op.REACH)[u.which]
    assert np.allclose(model.heads(u) + inside, whole)


def test_contexts_are_counted_over_all_ranges():
    """One unit in each of two ranges makes the tables of both units in one range."""

    def met(*words):
        own = op._Units(*op._lowered(op.pa.array(list(words))))
        all_of = np.arange(len(own.size))
        return op._Met([op._packed(own, all_of, [np.ones(len(all_of), dtype=np.int64)] * 2)], 2)

    def tables(*ranges):
        sent = {}
        for one in ranges:
            for segment, payload in op._events(one, one.counts[1]):
                sent.setdefault(segment, []).append(payload)
        made = {s: op._segment(s // op.SEGMENTS, x) for s, x in sent.items()}
        return {s: x for s, x in made.items() if any(x[1])}

    together = tables(met("xabcd", "yabcd"))
    assert together and tables(met("xabcd"), met("yabcd")) == together


def test_units_make_the_text():
    text = "  a bb \n\n" + "long" * 20 + "\tü".join(["x"] * 9) + " " * 60
    data, offsets = op._lowered(op.pa.array([text, "", None, "next"]))
    u = op._Units(data, offsets)
    whole = b"".join(u.cells[k, : u.size[k]].tobytes() for k in u.which)
    assert whole == (text + "next").encode() and u.row.max() == 3
    assert (u.word > 0)[u.which].sum() == len(text.split()) + 1


def test_odd_tables(docs):
    frame = docs("a b", "A B c").selectExpr("*", "1 as fold", "2 as score", "3 as seen")
    out = op.score(frame).collect()
    assert {r.rest.more.seen for r in out} == {3} and all(r.train_tokens == out[0].train_tokens for r in out)
    assert op.digest(frame.limit(0)).collect() == []
    held = next(i for i in range(99) if fold(i) == 2)
    (only,) = op.digest(docs((held, "no training document"))).collect()
    assert (only.held_out, only.n_known, only.train_tokens, only.base_score) == (True, 0, 0, 0.0)
