import pytest

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
EXTRA = ("n_words string, kept string, score string, mix string, run int, cls int, shard int, component_id int, "
         "host string, q string, row string, id int, n int, slot int, rank int, block int, v string, y int")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, extra columns whose names clash
    with columns that operators make."""
    long = " ".join(f"w{i % 701}x{i % 13}" for i in range(60_000))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t", None, "a"), (4, "one two", "en", None),
            (5, "same text " * 30, "en", "b"), (6, "same text " * 30, "en", "b"), (6, "same text " * 30, "en", "b"),
            (7, long, "en", "b"), (8, long + " end", "de", "b"), (None, "no id here at all", "en", "c"),
            (None, None, None, None), (9, "日本語 ünïcödé \u0085 x y", "fr", "c"), (10, None, "en", "a"),
            (11, "same text " * 30 + "tail", "en", "a"), (12, "you idiot, you pathetic loser " * 5, "en", "a")]
    base = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    for part in EXTRA.split(", "):
        name, kind = part.split()
        base = base.withColumn(name, F.lit(None).cast(kind))
    return base


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(None, 1, 1), (1, None, None), (5, 1, 0), (5, 1, 0), (12, 0, 1), (99, 0, 1)],
                                 "doc_id long, quality int, toxic int")
