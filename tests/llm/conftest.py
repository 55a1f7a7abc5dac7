import os

import pytest

from cohortloom.llm.staging import ready

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def pytest_configure(config):
    config.addinivalue_line("markers", "given: reads the given tables")


def pytest_collection_modifyitems(items):
    if not os.path.isdir(FOLDER):
        for item in items:
            if "given" in item.keywords:
                item.add_marker(pytest.mark.skip(reason="no test data"))


@pytest.fixture(autouse=True)
def workers(spark):
    ready(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs or (id, text, lang) triples."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
