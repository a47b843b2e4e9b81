import random

import pytest
from pyspark.sql import types as T

CLASHING = (
    "key body at tie spans score label n token bucket fp row id number tree leaf node size a b counts marks rep query item rank terms tfs "
    "__row __key __at __body __spans __tie _row _at _number"
).split()
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def frame(spark, rows):
    """Documents from (doc_id, text[, lang]) with extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), *["x"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    syllables = ["ta", "ri", "mon", "el", "qu", "ös", "ba", "né", "tion", "k"]
    book = ["".join(random.Random(i).choices(syllables, k=random.Random(i).randint(1, 3))) for i in range(vocabulary)]
    return " ".join(rng.choice(book) for _ in range(words))


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)


@pytest.fixture(scope="session")
def odd(make):
    """Null, empty, blank, one-letter, repeated, tied and very long texts; a missing and a repeated id."""
    long = prose(1, 40_000)
    rows = [(None, "no id at all"), (1, None), (2, ""), (3, " \n\t"), (4, "A"), (5, "x" * 60_000), (6, long), (7, long), (8, prose(2, 30)), (9, prose(2, 30)), (9, prose(2, 30)), (9, prose(3, 30)), (10, "123 456 !!!"), (11, "nul \x00 byte <|endoftext|>")]
    return make(rows)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
