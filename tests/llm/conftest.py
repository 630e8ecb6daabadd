import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source) rows."""

    def make(*rows, parts=3):
        out = []
        for i, row in enumerate(rows):
            doc_id, text, *source = row if isinstance(row, tuple) else (i, row)
            out.append((doc_id, text, "en", source[0] if source else f"s{i % 2}", len(text or "")))
        return spark.createDataFrame(out, DOC).repartition(parts)

    return make


@pytest.fixture(scope="session")
def noisy_texts():
    """Texts of a few words with copies, shared passages, odd blanks and letters of other scripts."""

    def make(seed, n=40, vocabulary=6, longest=90):
        rng = random.Random(seed)
        words = ["a", "Ab", "ü", "ñ!", "的", "zz", "x_1", "über"][:vocabulary]
        texts = []
        for _ in range(n):
            own = [rng.choice(words) for _ in range(rng.randrange(longest))]
            if texts and rng.random() < 0.4:
                other = rng.choice(texts).split()
                at = rng.randrange(len(other) + 1)
                cut = other[at : at + rng.randrange(60)]
                spot = rng.randrange(len(own) + 1)
                own[spot:spot] = cut
            if texts and rng.random() < 0.15:
                texts.append(rng.choice(texts))
            else:
                texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t", "  "]) for w in own))
        return texts

    return make
