import random
import re
from collections import Counter

import numpy as np
import pytest

from spendlens.llm import collocations as op
from spendlens.llm.text import lots

SCHEMA = "doc_id long, text string, lang string, word string, n long, ids int"


def wanted(rows, least, longest=5, first=2000):
    """All phrases counted and cut with Python integers."""
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    known = {p: a for p, a in counts.items() if a >= least}
    long_ones = [p for p in known if len(p) > 2]
    inner = {
        (p[0], *p[i : i + k])
        for p in long_ones
        for k in range(2, len(p) - 1)
        for i in range(1, len(p) - k + 1)
        if known[p] >= known[(p[0], *p[i : i + k])]
    }
    out = []
    for p, a in known.items():
        if len(p) > 2 and p not in inner:
            cuts = [(counts[p[: c + 1]], counts[(p[0], *p[c + 1 :])]) for c in range(1, len(p) - 1)]
            score, _, l, r = min((1000 * a * n[p[0]] // (l * r), c, l, r) for c, (l, r) in enumerate(cuts))
            out.append((p[0], " ".join(p[1:]), a, l, r, n[p[0]], score))
    ranked = []
    for lang in {p[0] for p in out}:
        own = sorted((p for p in out if p[0] == lang), key=lambda p: (-p[6], -p[2], p[1].encode()))
        ranked += [(lang, i, *p[1:]) for i, p in enumerate(own[:first], 1)]
    return sorted(ranked)


def run(spark, rows, least, parts=4, **more):
    table = spark.createDataFrame([(i, t, lang, "x", 1, 1) for i, (t, lang) in enumerate(rows)], SCHEMA)
    out = op.collocations(table.repartition(parts), least, **more)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "bigint", "string", *["bigint"] * 5]
    return sorted(tuple(r) for r in out.collect())


def drawn(seed, n=60, vocabulary=12, longest=60):
    rng = random.Random(seed)
    words = ["the", "Of", "ü", "Ünd", "的", "b-c", "x_1", "a'b", "zz", "q", "\x00", "/", "new", "york"][:vocabulary]
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", "\n", "!", " \r\n"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(longest)))
        if rng.random() < 0.3:
            text += " New  York\tcity hall of"
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("seed, least, vocabulary", [(1, 3, 12), (2, 6, 3), (3, 2, 14)])
def test_like_brute_force(spark, seed, least, vocabulary):
    rows = drawn(seed, vocabulary=vocabulary)
    want = wanted(rows, least)
    assert len(want) > 10 and max(len(w[2].split(" ")) for w in want) >= 3
    assert run(spark, rows, least) == want


def test_many_filters_ranges_and_hops_give_the_same(spark, monkeypatch):
    rows = drawn(4, n=90)
    want = wanted(rows, 2)
    monkeypatch.setattr(op, "WINDOWS", 50)
    monkeypatch.setattr(op, "ENTRIES", 20)
    monkeypatch.setattr(op, "HOP", 2)
    monkeypatch.setattr(op, "MERGED", 1 << 10)
    monkeypatch.setattr(op, "LOT", 300)
    assert run(spark, rows, 2) == want


def test_long_texts_are_cut_between_pieces_only(spark, monkeypatch):
    monkeypatch.setattr(op, "LOT", 200)
    text = "one two three four five, " * 400 + "no end here " * 100 + "; one two three"
    assert run(spark, [(text, "en"), ("one two", "en")], 50) == wanted([(text, "en"), ("one two", "en")], 50)
    data = np.frombuffer(text.encode(), np.uint8)
    parts = list(lots(data, np.array([0, len(data)]), 200, op._SEPARATORS))
    assert b"".join(p[0].tobytes() for p in parts) == text.encode() and len(parts) > 50


def test_overlaps_repeats_and_ties(spark):
    rows = [("a a a a", "en")] * 40 + [("b c", "en"), ("c b", "en")] * 30 + [("x " * 50, "de")] * 3
    assert run(spark, rows, 20) == wanted(rows, 20)
    assert run(spark, rows, 20, first=2) == wanted(rows, 20, first=2)
    assert run(spark, rows, 20, longest=3) == wanted(rows, 20, longest=3)


def test_nulls_empties_and_rare_words(spark):
    rows = [(None, "en"), ("", None), (" \t\n", "en"), ("...", "de"), ("rare words only", "en")]
    assert run(spark, rows, 2) == []
    assert run(spark, [], 1) == []
    assert run(spark, [("w" * 100_000 + " tail", "en")] * 3, 3) == wanted([("w" * 100_000 + " tail", "en")] * 3, 3)


@pytest.mark.parametrize("words, bits", [(2, 1), (2, 5), (5, 5), (3, 16), (4, 16), (5, 21), (5, 32), (3, 33), (2, 64)])
def test_the_permutation_is_undone(words, bits):
    packing = op.Packing(words, bits)
    rng = np.random.default_rng(words * bits)
    ids = rng.integers(1, (1 << bits) - 1, 500, endpoint=True, dtype=np.uint64)
    grams = np.stack([ids[i : i + 500 - words + 1] for i in range(words)], axis=1)
    lanes = packing.lanes(ids)
    assert np.array_equal(packing.ids(lanes), grams.astype(np.int64))
    assert all(int(lane.max()).bit_length() <= width for lane, width in zip(lanes, packing.widths))
    assert len(set(zip(*(lane.tolist() for lane in lanes)))) == len(set(map(tuple, grams.tolist())))


@pytest.mark.parametrize("words, bits, ranged", [(2, 4, 0), (2, 4, 8), (3, 10, 3), (5, 21, 8), (4, 16, 0), (5, 32, 5)])
def test_a_filter_keeps_every_entry(words, bits, ranged):
    packing = op.Packing(words, bits)
    rng = np.random.default_rng(bits)
    ids = rng.integers(1, (1 << bits) - 1, 3000, endpoint=True, dtype=np.uint64)
    lanes, counts = op._summed(packing.lanes(ids), None)
    counts = counts * rng.integers(1, 2, len(counts)) * np.where(rng.random(len(counts)) < 0.1, 1 << 40, 1)
    place = packing.place(lanes, ranged)
    for part in np.unique(place):
        own = [lane[place == part] for lane in lanes]
        raw = op.filter_of(own, counts[place == part], packing.widths, ranged)
        back, back_counts = op.entries_of(raw, packing.widths, ranged)
        assert all(np.array_equal(a, b) for a, b in zip(own, back, strict=True))
        assert np.array_equal(back_counts, counts[place == part])


def test_a_filter_is_compact():
    packing = op.Packing(3, 20)
    ids = np.random.default_rng(1).integers(1, 1 << 20, 200_000, endpoint=False, dtype=np.uint64)
    lanes, counts = op._summed(packing.lanes(ids), None)
    raw = op.filter_of(lanes, counts, packing.widths, 0)
    assert len(raw) < 8 * len(counts)  # 60 bits of key and 64 of count would be 16 bytes
