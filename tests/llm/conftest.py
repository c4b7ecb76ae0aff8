import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"word{i} of the shared passage" for i in range(30))
#: Extra columns have the names that operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, mark long, n long, count long, size long, page long, `key` string"


def edge_texts():
    """Null and empty texts, white space alone, ties, repeated rows, null ids, a very long text, a shared passage."""
    long = " ".join(f"w{i * i % 7919}" for i in range(60_000))
    near = [" ".join(f"n{i}" for i in range(100)) + f" tail{k}" for k in range(12)]
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "two words"), (7, long), (8, PASSAGE), (9, "x " + PASSAGE + " y"),
            (10, "a b c d " * 60), (11, "Ünïcode ▁ 漢字 😀 text\x00with\x01 odd▁ signs"), (11, "Ünïcode ▁ 漢字 😀 text\x00with\x01 odd▁ signs"),
            (12, "a b c d " * 60), (None, "no id here"), (None, PASSAGE), (-5, "two words"), (13, "<<>> ## $$ %% " * 30),
            (14, "line\nline\n\nline two\nline two\n" * 12), *((20 + k, x) for k, x in enumerate(near))]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, x, "en" if k % 3 else None, None if k % 5 == 0 else f"s{k % 3}", 0, "x", 1, 2, 3, 4, 5, "y") for k, (i, x) in enumerate(edge_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """(documents table, list of (id, text)) of the smallest test data."""
    if not os.path.exists(SF):
        pytest.skip("test tables not present")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
