"""Run the single-pass fact write three times -- undisturbed, with every task of
the write's result stage failing once, and with every scan (map) task before the
dedupe shuffle failing once -- and print the metric sets as JSON.

Executed in its own process by test_retries.py (local mode retries tasks only
with a ``local[N,maxFailures]`` master).
"""

import json
import os
import sys
import tempfile
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from curate.plans.catalogue_io import write_csv  # noqa: E402
from curate.plans.fixtures import encounters_raw, encounters_spec, mapping_lines  # noqa: E402
from curate.plans.silver import SilverConfig, build_dims, fact_plan  # noqa: E402
from curate.plans.sinks import ensure_db, save_table  # noqa: E402
from curate.plans.steplog import StepLog  # noqa: E402
from curate.sources.csv import read_permissive_csv  # noqa: E402


MARKERS = tempfile.mkdtemp(prefix="curate-retry-markers-")


def _fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        # leave evidence that this attempt failed, then fail it
        open(os.path.join(MARKERS, f"{ctx.stageId()}-{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return True


# nondeterministic, so the optimizer keeps it in place (in the write's result stage)
fail_first_attempt = F.udf(_fail_first_attempt, T.BooleanType()).asNondeterministic()


def run(spark, sf_dir, base, inject):
    raw = encounters_raw(spark, sf_dir)
    write_csv(raw, f"{base}/csv")
    spec = encounters_spec(raw)
    cfg = SilverConfig(base_dir=base, spec=spec, database=f"r_{uuid.uuid4().hex[:8]}")
    dims = build_dims(spark, mapping_lines(spark, sf_dir), cfg, StepLog(spark, cfg.log_dir))
    source = read_permissive_csv(spark, f"{base}/csv")
    if inject == "map":      # scan stage, before the dedupe shuffle: every map task fails once
        source = source.where(fail_first_attempt(F.lit(1)))
    plan = fact_plan(spark, source, cfg, dims, spec)
    out = plan.observed
    if inject == "result":   # same stage as the observations: every result task fails once
        out = out.where(fail_first_attempt(F.lit(1)))
    ensure_db(spark, cfg.database, f"{base}/{cfg.database}.db")
    saved = save_table(out, f"{cfg.database}.f", path=f"{base}/f")
    return {"clean": dict(plan.obs_clean.get), "rules": dict(plan.obs_rules.get),
            "rows_saved": saved["rows_saved"]}


if __name__ == "__main__":
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4")
             # keep 4 result tasks (no coalescing), so several attempts fail
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curate-retry-"))
    sf = sys.argv[1]
    a = run(spark, sf, tempfile.mkdtemp(prefix="curate-retry-a-"), inject=None)
    b = run(spark, sf, tempfile.mkdtemp(prefix="curate-retry-b-"), inject="result")
    n_result = len(os.listdir(MARKERS))
    c = run(spark, sf, tempfile.mkdtemp(prefix="curate-retry-c-"), inject="map")
    print(json.dumps({"plain": a, "retried": b, "map_retried": c,
                      "failed_attempts": n_result,
                      "failed_map_attempts": len(os.listdir(MARKERS)) - n_result}, default=int))
