"""Every training-data query with SQL against it, on the smallest tables."""

import os

import pytest

from quarry.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, sf, key):
    res = compare(spark, duck(sf), key, QUERIES[key], ORACLE[key], sf)
    assert res["status"] in ("strict", "close"), res


def test_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_nothing_else_imports_the_subpackage():
    import quarry
    root = os.path.dirname(quarry.__file__)
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as source:
                    assert "quarry.llm" not in source.read(), f
