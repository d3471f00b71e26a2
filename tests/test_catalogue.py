"""Every catalogue query against its DuckDB oracle (sf0.001; the driver checks sf0.01)."""

import pytest

from curate.plans.catalogue import ORACLE, QUERIES
from curate.plans.verify import compare

from conftest import SF_SMALL

import __spark_entry__ as E


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, duck_small, name, SF_SMALL, QUERIES[name], ORACLE[name])
    assert r["ok"], r


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(ORACLE) == set(QUERIES)          # every query of the library itself has an SQL oracle
    assert set(E.oracle_sql()) <= set(E.queries())
    assert [f.name for f in df.schema.fields] == ["age_group", "readmitted", "count", "total",
                                                  "percentage"]


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_REPS": "1", "BENCH_CPUS": "2"}
    r = subprocess.run([sys.executable, "bench.py", "top_parts", "null_profile"], cwd=repo,
                       env=env, capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stderr[-1500:]
    lines = [ln for ln in r.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and set(out["queries"]) == {"top_parts", "null_profile"}
