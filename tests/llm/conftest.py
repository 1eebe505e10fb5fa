"""Small awkward tables: nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_rows():
    rng = random.Random(3)
    words = ["river", "stone", "Über", "maison", "casa", "wind", "hill", "tree", "sea", "light", "fire", "road"]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base = say(60)
    parts = base.split(" ")
    near = " ".join([*parts[:30], "changed", *parts[31:]])
    far = " ".join([*parts[:20], *say(40).split(" ")])
    long = say(30_000)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, far, "en", "b"), (5, base.upper(), "en", None),
        (6, "", "en", "a"), (7, None, "fr", "a"), (8, "one two", None, None), (9, "One  two\n", "fr", "b"), (10, " \t\n", "fr", "c"),
        (11, long, "en", "a"), (12, long + " tail", "en", "a"), (13, base.replace(" ", "\n\n"), "en", "c"),
        (14, "12 34 !!", "de", "c"), (15, "Das ist nicht die Zeit und der Weg", "de", "c"), (None, say(12), "en", "b"),
        (16, say(8) + " " + " ".join(parts[:12]) + " " + say(5), "en", "a"), (17, "idiot", None, "a"),
        (18, say(25), "en", None), (18, say(25), "en", None), (19, "tie", "en", "d"), (20, "tie", "en", "d"),
    ]
    rows.append(rows[18])  # a repeated row
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with further columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = ("row", "spans", "items", "score", "kept", "comp", "hub", "shard", "size", "target", "_n", "key", "node")
    return awkward.select("*", *[F.lit(1).alias(c) for c in names])


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def items(spark):
    text = awkward_rows()[0][1]
    rows = [(1, text[: len(text) // 2]), (2, "one TWO"), (3, None), (4, ""), (None, "wind99 hill99"), (1, "one two"), (5, "das ist nicht")]
    return spark.createDataFrame(rows, "item_id long, text string")
