import re

import pytest

from spendlens.llm import mixing as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted(rows):
    """source -> (size, target), by sharing the excess again and again."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 2 * sizes[s]}
        for s in above or free:
            target[s] = 2.0 * sizes[s] if above else weight[s] * level
        if not above:
            break
        left -= sum(target[s] for s in above)
        free -= above
    return {s: (sizes[s], target[s]) for s in names}


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(900):
        source = [None, "b", "a", "Z", "é", "tiny"][i % 5 if i % 3 else 2]
        out.append((i, "w " * ((i * 37) % 90 + (i == 7) * 400), source))
    return [*out, (900, None, "a"), (901, " \n", "blank"), (902, "one", "tiny"), (902, "one", "tiny"), (None, "x y", "b")]


@pytest.mark.parametrize("bucket, fan", [(20_000, 64), (10, 3)])
def test_targets_and_words(docs, rows, bucket, fan):
    want = wanted(rows)
    out = op.mix(docs(*rows), bucket=bucket, fan=fan).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    taken, largest = dict.fromkeys(want, 0), dict.fromkeys(want, 0)
    for i, text, source in rows:
        r = by_id[i].pop()
        assert r.size == len(WORD.findall(text or "")) and r.source_size == want[source][0]
        assert r.target == pytest.approx(want[source][1], rel=1e-9)
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        ratio = want[source][1] / max(1, want[source][0])
        assert not r.size or int(ratio) <= r.copies <= int(ratio) + 1
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for source, (_, target) in want.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def test_reruns_and_partitions_agree(docs, rows):
    a, b = (sorted(map(tuple, op.digest(docs(*rows, parts=n)).collect()), key=repr) for n in (2, 7))
    assert a == b


def test_each_copy_count_keeps_its_mean(docs, monkeypatch):
    frame = docs(*((i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(60)))
    total = dict.fromkeys(range(60), 0)
    for seed in range(30):
        monkeypatch.setattr(op, "SEED", seed)
        for r in op.mix(frame).collect():
            total[r.doc_id] += r.copies
    for source in range(3):
        own = [total[i] / 30 for i in range(60) if i % 3 == source]
        r = next(r for r in op.mix(frame).collect() if r.doc_id == source)
        ratio = r.target / r.source_size
        assert sum(own) / len(own) == pytest.approx(ratio, abs=0.06)
        assert all(abs(x - ratio) < 0.4 for x in own)


def test_odd_tables(docs):
    frame = docs("a b", "c").selectExpr("*", "1 as size", "2 as target", "3 as words", "4 as open")
    assert op.mix(frame).count() == 2
    assert op.digest(frame.limit(0)).collect() == []
    assert [tuple(r)[1:] for r in op.digest(docs(None, "")).collect()] == [(0, 0, 0.0, 0)] * 2
