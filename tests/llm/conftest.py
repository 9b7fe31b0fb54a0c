import os

import pytest

SF = os.environ.get("QUARRY_TEST_SF", "/root/testdata/sf0.001")


def texts(spark, rows, extra=True):
    """A documents table from ``(doc_id, text)`` rows, with extra columns whose names the operators use inside."""
    schema = "doc_id long, text string"
    if extra:
        schema += ", lang string, source string, n_chars long, key long, component string, digest string, leader int"
        rows = [(d, t, "en", "s", len(t or ""), 1, "c", "d", 2) for d, t in rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return SF
