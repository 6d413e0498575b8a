import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG_TEXT = " ".join(f"w{i % 4999} x{i % 17}." for i in range(60_000))
#: Nulls, empty and blank texts, few words, other scripts, repeated rows, one very long text.
ROWS = [
    (1, "The cat sat on the mat and looked at the moon for hours", "en", "a", 5),
    (2, "the CAT sat on the mat and looked at the moon for hours", "en", "b", 5),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n ", "en", "a", 4),
    (6, "word", "en", "c", 4),
    (7, "two words", None, "b", None),
    (8, "Σας 東京 <|endoftext|> é straße  it's a@b.co +49 (30) 1234567", "xx", None, 9),
    (9, "Σας 東京 <|endoftext|> é straße  it's a@b.co +49 (30) 1234567", "xx", None, 9),
    (9, "Σας 東京 <|endoftext|> é straße  it's a@b.co +49 (30) 1234567", "xx", None, 9),
    (10, LONG_TEXT, "en", "a", len(LONG_TEXT)),
    (11, LONG_TEXT + " and a tail", "en", "a", len(LONG_TEXT) + 11),
    (None, "a text of nobody that has six or more words", None, None, None),
]


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows of every awkward kind, with columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ROWS, DOCUMENTS).repartition(2)
    names = ["copy", "text_hash", "bucket", "node", "spans", "words", "size", "n_lines", "range", "score", "__text"]
    return rows.select("*", *(F.lit("clash").alias(name) for name in names)).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
