"""Tables that every operator must survive: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import pytest

SF = "/root/testdata/sf0.001"
#: Names the operators use inside, as extra columns of their input.
CLASHING = ("digest", "keep_id", "score", "shard", "slot", "h", "sub", "fp", "tie", "doc", "piece", "length", "_text", "_words", "_d", "_i", "_tie", "range", "root", "n", "u", "v")
LONG = " ".join(f"word{k % 977} and{k % 13}" for k in range(120_000))

AWKWARD = [
    (1, "The same text, twice over.", "en", "a", 26),
    (2, "The same text, twice over.", "en", "a", 26),
    (2, "The same text, twice over.", "en", "a", 26),
    (3, "The same text, twice over.", None, None, None),
    (4, None, "en", "a", 0),
    (5, "", "en", "a", 0),
    (5, "", "en", "a", 0),
    (6, "   \n\t ", "en", "b", 5),
    (None, "a text without an id", "en", "b", 20),
    (None, "a text without an id", "en", "b", 20),
    (None, None, None, None, None),
    (7, LONG, "en", "b", len(LONG)),
    (8, LONG + " tail", "en", "b", len(LONG) + 5),
    (9, "été 日本語 “x” <|endoftext|> it's x² \x1c \xa0 end", "fr", "b", 40),
    (-10, "negative id", "de", "c", 11),
    (10, "one", "de", "c", 3),
    (11, "two words", "de", "c", 9),
    (9, "another text under the id nine", "fr", "b", 30),
]


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING]).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark, awkward):
    return spark.createDataFrame([], awkward.schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
