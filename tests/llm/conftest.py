import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names the operators use themselves
    T.StructField("size", T.LongType()), T.StructField("part", T.StringType()), T.StructField("n", T.LongType()), T.StructField("score", T.DoubleType()),
])


#: Further columns whose names the stages of the pipeline use or have used; each value tells its row.
CLASHING = ("start", "target", "turn", "source_size", "rejected", "lang_pred", "_text", "_id", "_doc", "_key", "_s", "_h", "row", "h", "o", "at", "last", "id", "lost", "doc", "sha", "_metadata")


def with_clashes(df):
    from pyspark.sql import functions as F

    told = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), F.coalesce(F.xxhash64("text").cast("string"), F.lit("")))
    return df.select("*", *[F.concat(F.lit(f"{c} of "), told).alias(c) for c in CLASHING])


def rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, copies and near copies."""
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    out = [(i, prose(r.randint(3, 120)).capitalize() + ".", r.choice(["en", "de"]), r.choice(["a", "b", "é", None]), 1, 2, "x", 3, 0.5) for i in range(60)]
    long = prose(30_000)
    hot = prose(40)
    out += [(100, None, None, None, None, None, None, None, None), (101, "", "en", "a", 0, 0, "", 0, 0.0), (102, " \n\t ", "en", "a", 0, 0, "", 0, 0.0)]
    out += [(103, long, "en", "b", 0, 0, "", 0, 0.0), (104, "word", "en", "b", 0, 0, "", 0, 0.0), (105, "12 34", None, "b", 0, 0, "", 0, 0.0)]
    out += [(110 + i, hot if i % 2 else hot + "  ", "en", "a", 0, 0, "", 0, 0.0) for i in range(30)]
    near = hot.split() * 2
    for i in range(20):
        w = list(near)
        w[r.randrange(len(w))] = f"edit{i}"
        out.append((150 + i, " ".join(w), "en", "a", 0, 0, "", 0, 0.0))
    out += [out[3]] * 3  # repeated rows
    out += [(None, "no id here at all", "en", "a", 0, 0, "", 0, 0.0), (None, None, None, None, None, None, None, None, None)]
    out += [(200, "Mail jo.do@mail.example.com, or +1 (212) 555-0100; 10.0.0.256 10.0.0.25 card 4111 1111 1111 1111.", "en", None, 0, 0, "", 0, 0.0)]
    out += [(201, "é×÷ <|endoftext|>  two  spaces\n\n 's it's  x 　y 12,5%\n", "de", "é", 0, 0, "", 0, 0.0)]
    return out


@pytest.fixture(scope="session")
def fixture_rows():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, fixture_rows):
    return with_clashes(spark.createDataFrame(fixture_rows, SCHEMA)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_clashes(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
