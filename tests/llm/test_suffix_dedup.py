import hashlib
import random

import pytest

from spendlens.llm import suffix_dedup as op


def brute(rows, length=50):
    data = [(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in data:
        for at in range(len(t) - length + 1):
            s = t[at : at + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for at in range(len(t) - length + 1):
            if least[t[at : at + length]] < i:
                gone[at : at + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((None if i < 0 else i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts_of(seed, n=40):
    rng = random.Random(seed)
    words = ["the ", "of and ", "üñ", "a", "的", "zz\n", "\x00", "xyxy"]
    texts = []
    for _ in range(n):
        own = "".join(rng.choice(words) for _ in range(rng.randrange(120)))
        if texts and rng.random() < 0.6:
            other = rng.choice(texts)
            at = rng.randrange(len(other) + 1)
            spot = rng.randrange(len(own) + 1)
            own = own[:spot] + other[at : at + rng.randrange(200)] + own[spot:]
        texts.append(rng.choice(texts) if texts and rng.random() < 0.1 else own)
    return texts


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"block_bytes": 300}), (3, {"block_bytes": 900, "hot": 2}), (4, {"hot": 1})])
def test_equals_brute_force(docs, seed, options):
    rows = [((i * 11) % 43, t) for i, t in enumerate(texts_of(seed))]
    found = op.remove_repeats(docs(*rows), **options)
    got = found.selectExpr("doc_id", "n_bytes", "n_removed", "cast(size(spans) as long)", "sha2(kept, 256)").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert sum(r[2] for r in got) > 500


def test_spans_and_kept_make_the_text(docs):
    for r in op.remove_repeats(docs(*enumerate(texts_of(7)))).collect():
        raw, at, kept = (r.text or "").encode(), 0, b""
        for s in r.spans:
            kept, at = kept + raw[at : s.start], s.end
        assert kept + raw[at:] == bytes(r.kept)


def test_odd_rows_and_columns(docs):
    passage = "".join(f"p{i}," for i in range(40))
    rows = [(None, passage), (1, passage), (1, passage), (2, None), (3, ""), (4, passage[:49]), (5, passage[:50]), (6, "a" * 3000), (7, "a" * 99)]
    frame = docs(*rows).selectExpr("*", "1 as block", "2 as kept", "3 as n_bytes", "4 as part")
    out = op.remove_repeats(frame)
    assert {r.rest.kept for r in out.collect()} == {2}
    got = out.selectExpr("doc_id", "n_bytes", "n_removed", "cast(size(spans) as long)", "sha2(kept, 256)").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert op.digest(frame.limit(0)).collect() == []
    assert op.digest(docs("only one")).count() == 1


def test_long_text(docs):
    rng = random.Random(8)
    long = "".join(chr(rng.randrange(97, 123)) for _ in range(400_000))
    got = sorted(map(tuple, op.digest(docs(long, "x" + long[1000:300_000] + "y")).collect()))
    assert [r[:4] for r in got] == [(0, 400_000, 0, 0), (1, 299_002, 299_000, 1)]


def test_merge_is_a_sort_and_knows_shared_prefixes():
    rng = random.Random(9)

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for _ in range(200):
        runs = []
        for _ in range(rng.randrange(9)):
            own = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(12)))
            runs.append((own, [shared(a, b) for a, b in zip([b"", *own], own, strict=False)]))
        run, place, same = op.merge(runs)
        out = [runs[r][0][i] for r, i in zip(run, place, strict=True)]
        assert out == sorted(s for own, _ in runs for s in own)
        assert same == [shared(a, b) for a, b in zip([b"", *out], out, strict=False)]
        assert len(set(zip(run, place, strict=True))) == len(out)
