import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_words long, row string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows and columns with clashing names."""
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", 7, "x"),
        (2, "one two three four five six seven eight nine ten eleven", "en", "b", 7, "x"),
        (3, "", "en", "a", None, None),
        (4, None, None, None, None, None),
        (5, long, "en", None, 1, "y"),
        (6, long + " more", "de", "b", 1, "y"),
        (7, "a b\n\n a  b\té \U0001f600 mail x.1@y.org ▁ +1 (234) 567-8901", "fr", "c", 0, ""),
        (7, "a b\n\n a  b\té \U0001f600 mail x.1@y.org ▁ +1 (234) 567-8901", "fr", "c", 0, ""),
        (8, "short", "en", "a", 0, ""),
        (9, "### $$$ %%% word### word$$$ word%%% word### word$$$ a1### b2$$$ c3%%% d4###", "en", "a", 0, ""),
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
