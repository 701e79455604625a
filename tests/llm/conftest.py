import random

import pytest
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, key string, n int, "
          "label string, rep string, token string, start long, score string, norm string, sha string, pos string")
#: Columns whose names the operators use inside.
CLASHING = 11


def prose(rng, n, words="abcdefghijklmnopqrstuvwxyz"):
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(2, 8))) for _ in range(n))


def messy_rows():
    """(doc_id, text): nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(11)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join(words[:60] + ["Changed"] + words[61:])
    return [
        (1, base), (2, base), (3, base.upper()), (4, near), (5, None), (6, ""), (7, "   \n\t "), (8, "one"), (9, "one two"),
        (10, prose(rng, 30_000)), (11, "Released under the MIT License.\n" + prose(rng, 40)), (12, "é" * 500), (13, "\x00a\x00b"),
        (14, "<|endoftext|> a <|endoftext|>"), (2, base), (2, "another text of an id seen before"), (None, base), (None, None),
        (15, prose(rng, 50) + " " + base + " " + prose(rng, 50)), (16, "a" * 3000), (17, "x y " * 2000),
    ]


@pytest.fixture(scope="session")
def messy(spark):
    rows = [(i, t, None if k % 3 else "en", None, None, *[None] * CLASHING) for k, (i, t) in enumerate(messy_rows())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 1, 0), (8, 1, 0), (16, 0, 0), (17, 0, 0), (12, 0, None), (None, 1, 0),
                                  (3, None, 0), (1, 1, 0), (10, 1, 0), (13, 0, 0), (7, 0, 0), (6, 0, 0)],
                                 "doc_id long, quality int, toxic int")


def by_row(df, *cols):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r[c] for c in cols) for r in df.select(*[F.col(c) for c in cols]).collect()),
                  key=lambda t: tuple((v is not None, v) for v in t))
