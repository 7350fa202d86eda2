import pytest

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
# names that the operators use themselves
CLASHING = ("score", "n_words", "h1", "h", "k1", "cid", "n", "copies", "label", "held_out", "spans")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls in every column, empty, blank and very long texts, repeated rows."""
    long_text = " ".join(f"word{i % 977} of line {i}" for i in range(12_000))
    line = "The quick brown fox jumps over the lazy dog near the old river bank today. " * 8
    return [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, long_text, "en", "b"),
            (5, line, "en", "b"), (5, line, "en", "b"), (6, line + "x", "en", None), (None, line + "y", None, "c"),
            (None, None, None, None), (7, "été, où? naïve Ünïcode — 漢字 🙂", "fr", "c"), (8, "one", "en", "c"),
            (9, "Licensed under CC BY-NC 4.0. All rights reserved", "en", "d"), (10, "x" * 900, "zz", "d")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows above with extra columns whose names the operators use."""
    extra = ", ".join(f"{c} string" for c in CLASHING)
    rows = [(i, t, lang, src, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, lang, src in odd_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("doc_id < 0")
