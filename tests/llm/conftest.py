import random

import pytest

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("n", T.StringType())])


def corpus() -> list[tuple]:
    """Small hard cases: nulls, empty, long, repeats within and across rows, ties, odd characters."""
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in ("ra", "to", "mi", "Ül", "ñe")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage, line = prose(300), prose(110), "A shared line of some length here"
    words = base.split(" ")
    edited = words.copy()
    edited[50] = "other"
    half = words[:150] + prose(150).split(" ")
    texts = [None, "", " \n\t ", "one", "one", "Two words", base, base, " ".join(edited), " ".join(half),
             prose(80) + " " + passage + " " + prose(80), prose(90) + "\n" + passage + "\n" + prose(20),
             line + "\n" + prose(30) + "\n" + line, prose(25) + "\n  " + line.upper() + " \r\nend",
             prose(40) + "\n" + line, "a" * 1500, "x y " * 700, prose(4000), "1234 5678 !!!\n" * 40,
             "日本語 テキスト ▁ \x00 \U0001f642 é", "#$% " * 60 + prose(30), prose(40) + "\n\n\n"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s0", None, "S")[i % 4], -1, "x", None, "y")
            for i, t in enumerate(texts)]
    rows += [(None, prose(50), "en", "s1", None, None, None, None), (6, base, "en", "s0", 5, "r", "r", "r"),
             (40, base, None, None, 5, "r", "r", "r"), (40, base, None, None, 5, "r", "r", "r"),
             (41, prose(30), "en", "s1", 1, "", "", "")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
