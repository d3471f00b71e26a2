"""Physical plan shape: broadcast FK joins, one scan per profile, top-k, pruning."""

from curate.plans.catalogue import QUERIES

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str, table: str) -> int:
    return plan.count(f"{table}.parquet")


def test_fk_check_broadcasts_and_scans_fact_once(spark):
    plan = _plan(QUERIES["fk_orphan_counts"](spark, SF_SMALL))
    # all three fact-side FK lookups are broadcast left joins (no fact shuffle for them);
    # joins inside the small mapping-file parse are left to AQE's runtime sizing
    assert plan.count("LeftOuter, BuildRight") == 3
    assert "SortMergeJoin [admission" not in plan and "SortMergeJoin [discharge" not in plan


def test_profiles_are_single_scan(spark):
    for name in ("null_profile", "cast_failure_profile", "rule_violations"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        # one scan of the input, not one per column / rule
        assert _scans(plan, "orders") == 1, name


def test_top_k_is_take_ordered(spark):
    for name in ("top_diagnoses", "top_parts"):
        plan = spark.sparkContext._jvm  # noqa: F841
        df = QUERIES[name](spark, SF_SMALL)
        assert "TakeOrderedAndProject" in df._jdf.queryExecution().sparkPlan().toString(), name


def test_scan_prunes_columns(spark):
    df = QUERIES["top_parts"](spark, SF_SMALL)
    plan = _plan(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_unlabelled_documents_does_not_read_text(spark):
    plan = _plan(QUERIES["unlabelled_documents"](spark, SF_SMALL))
    assert "text:string" not in plan


def test_single_pass_fact_plan_shape(spark, tmp_path):
    import uuid
    from curate.plans.catalogue_io import write_csv
    from curate.plans.fixtures import encounters_raw, encounters_spec, mapping_lines
    from curate.plans.silver import SilverConfig, build_dims, fact_plan
    from curate.plans.steplog import StepLog
    raw = encounters_raw(spark, SF_SMALL)
    write_csv(raw, str(tmp_path / "csv"))
    spec = encounters_spec(raw)
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), spec=spec,
                       database=f"p_{uuid.uuid4().hex[:8]}")
    dims = build_dims(spark, mapping_lines(spark, SF_SMALL), cfg, StepLog(spark, cfg.log_dir))
    plan = _plan(fact_plan(spark, str(tmp_path / "csv"), cfg, dims, spec).observed)
    fact_side = plan.split("BroadcastExchange")[0]
    assert fact_side.count("FileScan csv") == 1                      # one read of the raw input
    assert fact_side.count("Exchange hashpartitioning(encounter_id") == 1   # the only fact shuffle
    assert plan.count("LeftOuter, BuildRight") == 3                  # FK lookups broadcast
    # both metric observations sit above the shuffle (result stage)
    assert plan.index("CollectMetrics rules") < plan.index("CollectMetrics clean") \
        < plan.index("Exchange hashpartitioning(encounter_id")
    assert "partial_min(struct" in plan                              # dedupe pre-aggregates
