"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
collect); the reported time is the median of $BENCH_REPS (default 3) runs.  ``silver_run`` is the end-to-end flow -- mapping file -> three
dimensions, raw CSV -> curated fact in one pass, summaries, step log and
report -- with its Spark job count.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "curated_fact", "cast_failure_profile", "null_profile", "fk_orphan_counts", "rule_violations",
    "readmission_share", "top_diagnoses", "los_by_demographics", "dedupe_rows_lineitem",
    "dedupe_stats_lineitem", "top_parts", "avg_qty_by_flag", "event_share_by_type",
    "unlabelled_documents", "dim_build_type", "missing_expected_files",
)


def count_passes(events_dir: str, raw_path: str, fact_table: str) -> dict:
    """SQL executions of the last silver run: all of them, those scanning the raw CSV,
    and those reading the saved fact table."""
    raw_execs, fact_execs, run_execs = set(), set(), set()
    base = raw_path.split("/raw_extracted")[0]
    db = fact_table.split(".")[0]
    table = fact_table            # database name is unique per run
    files = [os.path.join(d, n) for d, _, names in os.walk(events_dir) for n in names]
    for path in files:
        with open(path, errors="replace") as f:
            for line in f:
                if "physicalPlanDescription" not in line:
                    continue
                ev = json.loads(line)
                plan, eid = ev.get("physicalPlanDescription", ""), ev.get("executionId")
                if base in plan or f"{db}." in plan:
                    run_execs.add(eid)
                if "Scan csv" in plan and raw_path in plan:
                    raw_execs.add(eid)
                writes = "InsertIntoHadoopFsRelationCommand" in plan.split("\n", 3)[1]
                if table in plan and "Scan" in plan and not writes:
                    fact_execs.add(eid)
    # execution ids are sequential and nothing else runs meanwhile: count the whole window
    window = (max(run_execs) - min(run_execs) + 1) if run_execs else 0
    return {"sql_executions": window, "raw_input_scans": len(raw_execs),
            "saved_fact_reads": len(fact_execs - raw_execs)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if not a.startswith("-")]

    from curate.plans.catalogue import QUERIES
    from curate.plans.catalogue_io import run_fixture_silver
    from curate.session import get_session

    # Spark's event log (scratch folder) lets us count which SQL executions read
    # the raw fact input -- the "fact passes" of one silver run.
    events_dir = tempfile.mkdtemp(prefix="curate-bench-events-")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                        driver_memory="16g",
                        extra={"spark.eventLog.enabled": "true",
                               "spark.eventLog.dir": f"file://{events_dir}",
                               "spark.eventLog.compress": "false"})
    sc = spark.sparkContext

    # Warm-up (not timed): the same queries on the smallest tables, so timings
    # reflect a warm JVM (JIT, codegen cache) rather than first-query compile cost.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in (only or HEADLINE):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    reps = max(1, int(os.environ.get("BENCH_REPS", "3")))
    times: dict[str, float] = {}
    jobs: dict[str, int] = {}

    def timed(name: str, run) -> object:
        samples, result = [], None
        for rep in range(reps):
            group = f"bench-{name}-{rep}"
            sc.setJobGroup(group, name)
            t0 = time.perf_counter()
            result = run()
            samples.append(time.perf_counter() - t0)
            jobs[name] = len(sc.statusTracker().getJobIdsForGroup(group))
        times[name] = round(statistics.median(samples), 3)
        return result

    for name in (only or HEADLINE):
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop")
              .mode("overwrite").save())

    input_rows, paths = None, None
    if not only:
        def silver():
            out = run_fixture_silver(spark, sf_dir)
            out["report"].write.format("noop").mode("overwrite").save()
            return out
        out = timed("silver_run", silver)
        input_rows = out["metrics"]["input_rows"]
        paths = (out["log"].records[1]["payload"]["input_csv"],
                 out["metrics"]["saved"]["table"])

    spark.stop()
    passes = count_passes(events_dir, *paths) if paths else None
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "jobs": jobs, "silver_input_rows": input_rows, "sf": sf,
        "cpus": cpus, "warm": True, "reps": reps, "stat": "median",
        "silver_run_passes": passes,
    }))


if __name__ == "__main__":
    main()
