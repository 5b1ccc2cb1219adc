import pytest

from llm_rows import AWKWARD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with the names that operators use inside.
CLASH = "_id long, _row long, key long, node long, fp long, size long, kept boolean, doc string, _text string, _doc long"


def document(doc_id, text, source="web"):
    return (doc_id, text, "en", source, None if text is None else len(text))


@pytest.fixture(scope="session")
def make_docs(spark):
    def build(rows):
        full = [document(*row) + (1,) * 6 + (True, "x", "y", 2) for row in rows]
        return spark.createDataFrame(full, f"{SCHEMA}, {CLASH}").repartition(3)

    return build


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture(scope="session")
def none(make_docs, awkward):
    return awkward.limit(0)
