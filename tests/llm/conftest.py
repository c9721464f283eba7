import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) rows, over a few partitions."""

    def make(rows, extra=False):
        df = spark.createDataFrame(list(rows), DOCS).repartition(3)
        if extra:
            # columns that operators use themselves, with other contents
            names = "start length fingerprint fp key component_id ids hashes words spans base score text_hash __text".split()
            df = df.selectExpr("*", *[f"'x' AS {name}" for name in names])
        return df

    return make


#: What every operator has to take: null, empty and blank texts, ties, repeated rows, null ids.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "One two three."),
    (4, "One two three."),
    (5, "One two three."),
    (None, "One two three."),
    (6, "é ß 漢字 🙂 " * 3),
    (7, "word " * 5000),
    (8, "x" * 30000),
]
