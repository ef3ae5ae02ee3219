import random

import pytest

COLUMNS = "doc_id long, text string, lang string, n_words long, spans string, kept string, score string, lines string, node string"


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, odd white space, nulls, empty and very long texts."""
    rng = random.Random(11)
    vocabulary = [rng.choice("abcdefghij") * rng.randint(1, 3) + str(k) for k in range(400)] + ["É", "日本", "Straße", "MIT", "License"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = words(60)
    texts = [None, "", " \n\t ", "one", "one two", "One  TWO", "."]
    for _ in range(40):
        base = words(rng.randint(1, 160))
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
    for _ in range(12):
        at = rng.randint(0, 30)
        own = words(at) + passage[rng.randint(0, 10) :] + words(rng.randint(0, 30))
        texts.append("\n".join(" ".join(own[i : i + 7]) for i in range(0, len(own), 7)))
    texts.append(" ".join(words(30_000)))
    texts.append("same " * 500)
    rows = [(k, t) for k, t in enumerate(texts)]
    # A repeated row, an id with two texts, and null ids.
    return [*rows, rows[20], (20, "another text of the same id"), (None, texts[30]), (None, None)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", 1, "s", "k", "x", "l", "n") for i, t in corpus], COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
