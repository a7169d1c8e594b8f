import random

import pytest
from pyspark.sql import functions as F

from mailfacts.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls everywhere, blank, short, repeated, foreign and very long texts, and ids that repeat.
EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t\x0b\x0c\r ", "en", "a", 6),
    (4, "one", None, "a", 3),
    (5, "A b C d e F g h i j k l m n o p", "en", "b", 31),
    (5, "A b C d e F g h i j k l m n o p", "en", "b", 31),
    (None, "a text without an id stands here", "en", None, 32),
    (6, "word " * 30_000, "en", "b", 150_000),
    (7, "É ñandú ß Öl 漢字 \U0001f600 é", "es", "c", 20),
    (8, "x" * 50_000, "en", "c", 50_000),
    (9, "a b c d e f g h i j k l m n o p\na b c d e f g h i j k l m n o p", "en", "c", 63),
]


@pytest.fixture
def documents(spark):
    prepare(spark)

    def make(rows):
        full = [(*row, *(None,) * (5 - len(row))) for row in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def edge(documents):
    return documents(EDGE)


@pytest.fixture
def clashing(edge):
    """The same rows with extra columns named like those the operators work with."""
    names = "id h w t l s n key size text_hash gone hit_id score kept n_words rep component bucket held_out label y ids row".split()
    return edge.select("*", *(F.lit(f"clash {n}").alias(n) for n in names))


@pytest.fixture
def prose():
    """Random texts over a small vocabulary, some of them slightly changed or copied."""

    def make(count, seed=1, words=400, length=(5, 120)):
        rng = random.Random(seed)
        vocabulary = [f"w{i}" for i in range(words)]
        texts = []
        for _ in range(count):
            if texts and rng.random() < 0.5:
                old = rng.choice(texts).split()
                for _ in range(rng.randint(0, max(1, len(old) // 25))):
                    old[rng.randrange(len(old))] = rng.choice(vocabulary)
                texts.append(" ".join(old))
            else:
                texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(*length))))
        return texts

    return make
