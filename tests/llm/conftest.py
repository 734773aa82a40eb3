import duckdb
import pytest

from care_analytics.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
# nulls, empty and blank texts, repeated rows, a long word, control strings, and a column that clashes with an added one
ODD = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (4, "a b c"), (5, "A  b\nc"), (None, "a b c"), (6, "é" * 900), (7, "x" * 30_000),
       (8, "<|endoftext|> </s>[INST] don't  stop \t\n\n"), (9, "日本語 ½ Ⅷ 😀" * 40), (10, "one two three four five six seven eight nine ten " * 30)]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, 1, "x") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, removed string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("doc_id > 1000")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts():
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())
