import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents, plus texts that are odd in one way each."""
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd(spark))


ODD = [
    (9001, None),
    (9002, ""),
    (9003, " \t\n "),
    (9004, "one"),
    (9005, "Same text twice here now and then"),
    (9005, "Same text twice here now and then"),
    (9006, "Same text twice here now and then"),
    (None, "a row without a key"),
    (9007, "x" * 40_000),
    (9008, "1 " * 20_000),
    (9009, "tab\tand\x0bother\x0cspace\r\nend 　wide fixed"),
    (9010, "\x1c control \x00 � \U0001f600 é é ẞ ΣΣ"),
    (9011, "<|endoftext|> <|startoftext|>a<|endoftext|>"),
]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, score double, kept boolean, rank int")


def clashing(df):
    """The frame with further columns named as results or inner columns of operators are."""
    from pyspark.sql import functions as F

    names = "score kept node rank label piece length n_words pii spans set list a b host formatted quality __order".split()
    return df.withColumns({n: F.lit(n) for n in names if n not in df.columns})
