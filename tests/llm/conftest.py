import pytest

LONG = "word" + " ".join(f"w{k}" for k in range(30000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns with clashing names."""
    same = "one two three four five six seven eight nine ten eleven twelve\n" * 6
    rows = [
        (1, same, "en", "a"),
        (2, same, "en", "a"),
        (2, same, "en", "a"),
        (3, None, None, None),
        (4, "", "", ""),
        (5, LONG, "en", "b"),
        (None, same, "en", "a"),
        (6, "  \t\n ", "de", "b"),
        (7, "Ünïcode ▁ <s> 'tis ①\x00 x " * 20, "fr", "c"),
        (-9, "a b c", "en", "a"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "length(text) as n_chars", "1 as label", "'x' as key", "2 as ids", "3 as rep", "4 as node", "5 as score", "6 as _id", "7 as _gone", "8 as _hash", "9 as _row", "10 as before", "11 as hash")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (5, 1, 0), (None, 1, 1), (7, None, None), (4, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
