"""Render the physical plans of the key queries (``python -m curate.plans.explain``).

Writes the tree part of ``explain("formatted")`` for each query, so scans
(``ReadSchema``/pushed filters), exchanges, join strategies and aggregation
modes can be reviewed side by side.
"""

from __future__ import annotations

import sys
import uuid

KEY_QUERIES = ("curated_fact", "null_profile", "rule_violations", "fk_orphan_counts",
               "top_diagnoses", "readmission_share", "los_by_demographics",
               "dedupe_rows_lineitem", "top_parts", "unlabelled_documents",
               "missing_expected_files", "event_share_by_type")


def tree(df, width: int = 170, max_lines: int = 70) -> str:
    """The operator tree of the executed (pre-AQE) physical plan, clipped for reading."""
    lines = df._jdf.queryExecution().executedPlan().treeString().splitlines()
    out = [ln if len(ln) <= width else ln[:width] + " ..." for ln in lines[:max_lines]]
    if len(lines) > max_lines:
        out.append(f"... ({len(lines) - max_lines} more lines: dimension / mapping-file subplans)")
    return "\n".join(out)


def fact_write_plan(spark, sf_dir: str) -> str:
    from curate.plans.catalogue_io import write_csv
    from curate.plans.fixtures import encounters_raw, encounters_spec, mapping_lines
    from curate.plans.silver import SilverConfig, build_dims, fact_plan
    from curate.plans.steplog import StepLog
    from curate.session import shared_dir
    base = shared_dir(spark, "explain")
    raw = encounters_raw(spark, sf_dir)
    write_csv(raw, f"{base}/csv")
    spec = encounters_spec(raw)
    cfg = SilverConfig(base_dir=base, spec=spec, database=f"x_{uuid.uuid4().hex[:8]}")
    dims = build_dims(spark, mapping_lines(spark, sf_dir), cfg, StepLog(spark, cfg.log_dir))
    return tree(fact_plan(spark, f"{base}/csv", cfg, dims, spec).observed)


def main(argv: list[str]) -> int:
    from curate.plans.catalogue import QUERIES
    from curate.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session()
    out = ["# Physical plans of the key queries", "",
           f"Generated by `python -m curate.plans.explain` on `{sf_dir}` (pre-AQE executed plan).",
           ""]
    out += ["## silver fact write (single pass)", "", "```", fact_write_plan(spark, sf_dir), "```", ""]
    for name in KEY_QUERIES:
        out += [f"## {name}", "", "```", tree(QUERIES[name](spark, sf_dir)), "```", ""]
    print("\n".join(out))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
