"""Differential check of catalogue queries against their DuckDB oracles.

Compares row count, column names and types, and the multiset of row values
(floats to 1e-9 relative).  Used by the tests and by ``python -m curate.plans.verify``.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable

from pyspark.sql import SparkSession

from curate.sources.tables import TABLES

TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
            "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", float(f"{v:.12g}"))
    if v is None:
        return ("~",)
    return ("v", str(v))


def _rows(records: Iterable[tuple]) -> list[tuple]:
    return sorted(tuple(_norm(v) for v in r) for r in records)


def compare(spark: SparkSession, con, name: str, sf_dir: str, query, sql: str) -> dict:
    df = query(spark, sf_dir)
    s_cols = [f.name for f in df.schema.fields]
    s_types = [TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "types_match": s_types == d_types}
    if not out["columns_match"]:
        out["columns"] = (s_cols, d_cols)
    if not out["types_match"]:
        out["types"] = (s_types, d_types)
    out["values_match"] = out["columns_match"] and _rows(s_rows) == _rows(d_rows)
    if not out["values_match"] and out["columns_match"]:
        a, b = _rows(s_rows), _rows(d_rows)
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_oracle"] = [r for r in b if r not in sa][:3]
    out["ok"] = (out["spark_rows"] == out["oracle_rows"] and out["columns_match"]
                 and out["types_match"] and out["values_match"])
    return out


def main(argv: list[str]) -> int:
    from curate.plans.catalogue import ORACLE, QUERIES
    from curate.session import get_session
    sf_dir = next((a.split("=", 1)[1] for a in argv if a.startswith("--sf=")),
                  "/root/testdata/sf0.01")
    names = [a for a in argv if not a.startswith("--")] or sorted(ORACLE)
    spark = get_session()
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        if n not in ORACLE:
            print(f"{n}: no oracle")
            continue
        try:
            r = compare(spark, con, n, sf_dir, QUERIES[n], ORACLE[n])
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "FAIL") + f" {r}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
