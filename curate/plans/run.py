"""End to end (PIPE5): archives -> bronze members -> silver tables -> reports.

Stops at the first failing layer (the failing step is logged before the
error propagates).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from curate.plans.bronze import EXPECTED_FILES, BronzeConfig, member_dir, run_bronze
from curate.plans.silver import SilverConfig, run_silver
from curate.sources.csv import header_names
from curate.sources.lines import read_lines
from curate.spec import ENCOUNTERS, FactSpec


def run_all(spark: SparkSession, base_dir: str, archive_path: str,
            spec: FactSpec = ENCOUNTERS, fact_file: str = EXPECTED_FILES[0],
            mapping_file: str = EXPECTED_FILES[1], database: str = "silver",
            pipeline_prefix: str = "", restrict: bool = False) -> dict:
    """Bronze then silver.  ``restrict`` narrows ``spec`` to the columns the
    extracted fact file actually has (otherwise a missing column is an error)."""
    bronze_cfg = BronzeConfig(base_dir=f"{base_dir}/bronze", archive_path=archive_path,
                              expected=(fact_file, mapping_file),
                              pipeline_name=f"{pipeline_prefix}Bronze Layer ETL")
    bronze = run_bronze(spark, bronze_cfg)
    silver_cfg = SilverConfig(base_dir=f"{base_dir}/silver", spec=spec, database=database,
                              pipeline_name=f"{pipeline_prefix}Silver Layer ETL")
    fact_dir = member_dir(bronze["extract_dir"], fact_file)
    if restrict:
        spec = spec.restrict(header_names(spark, fact_dir))
    lines = read_lines(spark, member_dir(bronze["extract_dir"], mapping_file))
    silver = run_silver(spark, silver_cfg, fact_dir, lines, spec=spec)
    return {"bronze": bronze, "silver": silver}


def main(argv: list[str]) -> int:
    """``python -m curate.plans.run <archive_path> <base_dir> [database] [--restrict]``."""
    import json
    args = [a for a in argv if not a.startswith("--")]
    if len(args) < 2:
        print(main.__doc__)
        return 2
    from curate.session import get_session
    spark = get_session()
    out = run_all(spark, base_dir=args[1], archive_path=args[0],
                  database=args[2] if len(args) > 2 else "silver",
                  restrict="--restrict" in argv)
    for name, summary in out["silver"]["summaries"].items():
        print(f"[{name}]")
        summary.show(20, truncate=False)                  # bounded preview (SRT4)
    for layer in ("bronze", "silver"):
        report = out[layer]["report"]
        row = report.first().asDict(recursive=True) if report is not None else None
        print(json.dumps({layer: row}, default=str))
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main(sys.argv[1:]))
