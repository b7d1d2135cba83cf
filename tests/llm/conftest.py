import pytest

from strata.llm.common import prepared


@pytest.fixture(scope="session")
def llm(spark):
    """The session as the registered queries prepare it."""
    prepared(lambda s: None)(spark)
    return spark


DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid string, h1 string, class_id string"


@pytest.fixture(scope="session")
def frame(llm):
    """(doc_id, text) pairs -> documents with extra columns of clashing names."""
    def make(rows):
        return llm.createDataFrame([(i, t, "en", "s", len(t or ""), "u", "h", "c") for i, t in rows], DOCS)
    return make
