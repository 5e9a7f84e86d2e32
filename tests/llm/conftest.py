import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text[, source]) with an extra column whose name an
    operator also uses inside."""

    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x") for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, source string, row string")

    return make
