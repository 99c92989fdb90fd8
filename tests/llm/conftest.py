import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, component_id long, blob string, findings string, row string"
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions in a dark stone tower near the old river"


def row(doc_id, text):
    return (doc_id, text, "en", "s", len(text or ""), 0.5, "f", 1, "b", "x", "r")


@pytest.fixture(scope="session")
def edge_rows():
    """NULL ids and texts, empty, blank and very long texts, ties, repeated rows, odd characters."""
    return [
        row(1, PROSE),
        row(2, PROSE),
        row(2, PROSE),
        row(None, PROSE + " and more"),
        row(3, None),
        row(4, ""),
        row(5, " \t\n\x0b\x0c\r "),
        row(None, None),
        row(6, "one"),
        row(7, "One TWO"),
        row(8, "straße Éclair ÉCLAIR naïve 数据  x\u0085y \x1cz 'tis don't <|endoftext|> <|startoftext|>a"),
        row(9, " ".join(f"w{i % 977}" for i in range(30_000))),
        row(10, "a" * 20_000),
        row(11, PROSE.upper()),
    ]


@pytest.fixture
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def docs_of(spark):
    def make(texts):
        return spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA)

    return make


@pytest.fixture
def given(spark, folder):
    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return table
