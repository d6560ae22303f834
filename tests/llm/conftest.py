import random

import pytest

from cohortgram.plans.storage import Scratch

DOCS = "doc_id long, text string"


@pytest.fixture
def scratch(spark):
    return Scratch(spark)


@pytest.fixture
def docs(spark):
    """A table of (doc_id, text) rows."""

    def make(rows, schema=DOCS):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return make


@pytest.fixture
def prose():
    """Invented prose: sentences of 4 to 12 words out of 4,000."""
    choose = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(choose.choice(letters) for _ in range(choose.randint(2, 9))) for _ in range(4000)]

    def make(count):
        out = []
        while len(out) < count:
            sentence = [choose.choice(words) for _ in range(min(choose.randint(4, 12), count - len(out)))]
            out += [*sentence[:-1], sentence[-1] + "."]
        return out

    return make
