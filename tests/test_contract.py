"""Driver contract: oracle coverage and the bench's one-line JSON."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E
from quarry.plans.registry import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
# model fits: no SQL form, checked on row count only
ROWS_ONLY = {"als_rmse", "als_bias_rmse"}


def test_every_query_has_an_oracle_but_the_model_fits():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q)
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="row_count,topk_counts")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and set(res["queries"]) == {"row_count", "topk_counts"}
    assert res["value"] == round(sum(res["queries"].values()), 3)
