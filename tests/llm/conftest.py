from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
WORDS = [a + b for a in "ba ce di fo gu hy".split() for b in "lan mor net pis rud tak".split()]


def prose(rng: random.Random, words: int, per_line: int = 9) -> str:
    out = [rng.choice(WORDS) + rng.choice(["", "", "s", "ing"]) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + per_line]) for i in range(0, words, per_line))


def corpus() -> list[tuple]:
    """Unlike texts, exact and near copies, shared passages, odd and empty texts, repeated rows."""
    rng = random.Random(7)
    passage = prose(rng, 60)
    texts: list[str | None] = [prose(rng, rng.randint(1, 150)) for _ in range(25)]
    texts += [texts[3], texts[3].upper(), texts[4] + " tail", None, "", "", " \n ", "é\n" * 40, "a"]
    texts += [prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 20) for _ in range(6)]
    texts += ["ab" * 300, "x" * 450, "one two three", "one two three", "ONE two  three"]
    for k in range(6):  # copies with one or two words changed
        words = texts[5].split(" ")
        for _ in range(k // 2):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    rows[7] = (7, rows[7][1], None, None, None)
    return [*rows, rows[0], rows[0]]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(corpus(), DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
