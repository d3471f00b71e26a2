"""End-to-end silver flow: one fact pass, log, report; failure logging."""

import json
import uuid

import pytest

from curate.plans.catalogue import QUERIES
from curate.plans.catalogue_io import run_fixture_silver
from curate.plans.silver import SilverConfig, curate_fact
from curate.plans.steplog import StepLog
from curate.sources.steplog import read_step_log

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def silver(spark):
    return run_fixture_silver(spark, SF_SMALL)


def test_log_has_every_step_and_report_agrees(silver, spark):
    steps = [r["step"] for r in silver["log"].records]
    assert steps[0] == "silver_dim__create_dimensions" and steps[-1] == "silver_analytics__healthcare_summary"
    assert len(steps) == 10 and all(r["status"] == "SUCCESS" for r in silver["log"].records)
    rep = silver["report"].first()
    assert rep.total_steps == 10 and rep.success_steps == 10
    m = silver["metrics"]
    assert rep.input_rows == m["input_rows"] and rep.output_rows == m["saved"]["rows_saved"]
    assert json.loads(rep.violations_by_constraint) == m["violations"]


def test_single_pass_metrics_equal_operator_queries(silver, spark):
    m = silver["metrics"]
    prof = {r.column: r.null_count for r in QUERIES["null_profile"](spark, SF_SMALL).collect()}
    assert {k: v["null_count"] for k, v in m["missing_values"].items()} == prof
    fk = {r.fk: r.orphaned_fact_rows for r in QUERIES["fk_orphan_counts"](spark, SF_SMALL).collect()}
    assert {k: v["orphaned_fact_rows"] for k, v in m["fk_validation"].items()} == fk
    rules = {r.constraint: r.violations for r in QUERIES["rule_violations"](spark, SF_SMALL).collect()}
    assert m["violations"] == rules
    casts = {r.column: r.failed_rows for r in QUERIES["cast_failure_profile"](spark, SF_SMALL).collect()}
    assert {k: v["failed_rows"] for k, v in m["casting_failures"].items()} == casts
    saved = silver["fact"]
    assert saved.count() == QUERIES["curated_fact"](spark, SF_SMALL).count()


def test_failed_step_is_logged_and_raised(spark, tmp_path):
    from curate.spec import ENCOUNTERS
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), database=f"t_{uuid.uuid4().hex[:8]}")
    log = StepLog(spark, cfg.log_dir)
    bad = spark.createDataFrame([("1",)], "encounter_id string")
    with pytest.raises(Exception):
        curate_fact(spark, bad, cfg, log, {}, ENCOUNTERS)       # missing columns
    rec = read_step_log(spark, cfg.log_dir, log.run_id).collect()
    # the columns are missed by the step that types them
    assert [(r.step, r.status) for r in rec] == [("silver_fact_ingest__hard_schema_exact", "FAILED")]
    assert "error" in json.loads(rec[0].payload)


def test_missing_input_fails_the_load_step(spark, tmp_path):
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), database=f"t_{uuid.uuid4().hex[:8]}")
    log = StepLog(spark, cfg.log_dir)
    with pytest.raises(Exception):
        curate_fact(spark, str(tmp_path / "absent.csv"), cfg, log, {})
    assert [(r["step"], r["status"]) for r in log.records] == [("silver_fact_ingest__load_csv", "FAILED")]


def test_missing_dimension_fails_the_integrity_step_unless_optional(spark, tmp_path):
    from dataclasses import replace
    from curate.spec import ENCOUNTERS
    spec = ENCOUNTERS.restrict(["encounter_id", "race", "admission_type_id"])
    raw = spark.createDataFrame([("1", "a", "7")], "encounter_id string, race string, admission_type_id string")
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), spec=spec, database=f"t_{uuid.uuid4().hex[:8]}")
    log = StepLog(spark, cfg.log_dir)
    with pytest.raises(ValueError, match="no dimension table"):
        curate_fact(spark, raw, cfg, log, {}, spec)
    assert [(r["step"], r["status"]) for r in log.records] == [
        ("silver_validation__referential_integrity", "FAILED")]
    optional = replace(spec, fks=tuple(replace(k, optional=True) for k in spec.fks))
    _, m = curate_fact(spark, raw, cfg, StepLog(spark, cfg.log_dir), {}, optional)
    assert m["fk_validation"] == {} and m["rows_after"] == 1


def test_string_orphans_do_not_depend_on_dimension_size(spark, tmp_path):
    from dataclasses import replace
    from pyspark.sql import types as T
    from curate.spec import ENCOUNTERS, FkSpec
    base = ENCOUNTERS.restrict(["encounter_id", "race"])
    spec = replace(base, schema=T.StructType([*base.schema.fields, T.StructField("code", T.StringType())]),
                   fks=(FkSpec("code", "d_code", "id"),))
    raw = spark.createDataFrame([("1", "x", " a"), ("2", "x", "a"), ("3", "x", "b"), ("4", "x", None)],
                                "encounter_id string, race string, code string")
    dims = {"d_code": spark.createDataFrame([("a",)], "id string")}
    found = []
    for bound in (2_000_000, 0):
        cfg = SilverConfig(base_dir=str(tmp_path / f"run{bound}"), spec=spec, broadcast_max_ids=bound,
                           database=f"t_{uuid.uuid4().hex[:8]}")
        _, m = curate_fact(spark, raw, cfg, StepLog(spark, cfg.log_dir), dims, spec)
        found.append(m["fk_validation"]["code"])
    assert found[0] == found[1] == {"valid_dim_values": 1, "orphaned_fact_rows": 2}


def test_reused_run_id_goes_on_counting(spark, tmp_path):
    from curate.plans.report import build_report
    d = str(tmp_path / "log")
    StepLog(spark, d, "r1").write("silver_fact_save", "FAILED", {})
    again = StepLog(spark, d, "r1")
    again.write("silver_fact_save", "SUCCESS", {"rows_saved": 5})
    assert again.records[0]["seq"] == 2
    rep = build_report(read_step_log(spark, d, "r1"), "p", "silver").first()
    assert rep.steps_status == {"silver_fact_save": "SUCCESS"} and rep.output_rows == 5


def test_step_context_manager(spark, tmp_path):
    log = StepLog(spark, str(tmp_path / "log"))
    with log.step("ok") as p:
        p["n"] = 1
    with pytest.raises(ValueError):
        with log.step("bad", input_csv="x"):
            raise ValueError("boom")
    rows = sorted((r.seq, r.step, r.status) for r in read_step_log(spark, log.log_dir).collect())
    assert rows == [(1, "ok", "SUCCESS"), (2, "bad", "FAILED")]


@pytest.mark.parametrize("stream", [True, False])
def test_bronze_extracts_expected_members_and_reports_missing(spark, tmp_path, stream):
    import io
    import zipfile
    from curate.plans.bronze import BronzeConfig, member_dir, run_bronze
    d = tmp_path / "zips"
    d.mkdir()
    for i in range(3):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("dataset/", b"")
            zf.writestr("dataset/diabetic_data.csv", f"encounter_id,race\n{i},x\n".encode())
            zf.writestr("dataset/other.txt", b"skip")
        (d / f"a{i}.zip").write_bytes(buf.getvalue())
    cfg = BronzeConfig(base_dir=str(tmp_path / "bronze"), archive_path=str(d), stream=stream)
    out = run_bronze(spark, cfg)
    assert out["missing"] == ["IDS_mapping.csv"]
    rep = out["report"].first()
    assert rep.files_extracted == 3 and rep.archives_read == 3
    assert json.loads(rep.expected_missing) == ["IDS_mapping.csv"]
    back = spark.read.option("header", True).csv(member_dir(out["extract_dir"], "diabetic_data.csv"))
    assert sorted(r.encounter_id for r in back.collect()) == ["0", "1", "2"]
    payload = out["log"].records[-1]["payload"]
    assert payload["exported_files_count"] == 3
    assert spark.read.parquet(payload["exported_files"]).count() == 3
    assert rep.csv_files_found == 3 and rep.total_rows == 3
    assert rep.zip_size_mb == round(sum(p.stat().st_size for p in d.iterdir()) / (1 << 20), 2)


@pytest.mark.parametrize("stream", [True, False])
def test_bronze_rerun_reads_only_its_own_members(spark, tmp_path, stream):
    import zipfile
    from curate.plans.bronze import BronzeConfig, member_dir, run_bronze
    for name, rows in (("one", "1\n"), ("two", "2\n")):
        (tmp_path / name).mkdir()
        with zipfile.ZipFile(tmp_path / name / f"{name}.zip", "w") as zf:
            zf.writestr("x/f.csv", f"id\n{rows}")
    for name, want in (("one", ["1"]), ("two", ["2"])):
        cfg = BronzeConfig(base_dir=str(tmp_path / "b"), archive_path=str(tmp_path / name), expected=("f.csv",), stream=stream)
        out = run_bronze(spark, cfg, run_id="same")
        got = spark.read.option("header", True).csv(member_dir(out["extract_dir"], "f.csv")).collect()
        assert [r.id for r in got] == want and out["manifest"].count() == 1


def test_members_of_one_archive_are_read_by_several_tasks(spark, tmp_path):
    import zipfile
    from pyspark.sql import functions as F
    from curate.sources.archive import expand_archives
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as zf:
        for i in range(100):
            zf.writestr(f"m/{i}.txt", f"text {i}")
    rows = expand_archives(spark, str(tmp_path)).withColumn("p", F.spark_partition_id()).collect()
    assert sorted(r.text for r in rows) == sorted(f"text {i}" for i in range(100))
    assert len({r.p for r in rows}) > 1


def test_members_that_an_archive_holds_twice_stay_apart(spark, tmp_path):
    import warnings
    import zipfile
    from curate.sources.archive import extract_members
    (tmp_path / "z").mkdir()
    with warnings.catch_warnings(), zipfile.ZipFile(tmp_path / "z" / "a.zip", "w") as zf:
        warnings.simplefilter("ignore")
        zf.writestr("f.csv", "first")
        zf.writestr("f.csv", "second")
    assert extract_members(spark, str(tmp_path / "z"), str(tmp_path / "out")).count() == 2
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["first", "second"]


def test_divert_mode_writes_bad_records_and_counts_them(spark, tmp_path):
    from curate.plans.silver import SilverConfig, curate_fact
    from curate.spec import ENCOUNTERS
    spec = ENCOUNTERS.restrict(["encounter_id", "race"])
    p = tmp_path / "in.csv"
    p.write_text("encounter_id,race\n1,a\n2,b,extra\n3,c\n4\n")
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), spec=spec, on_corrupt="divert",
                       database=f"t_{uuid.uuid4().hex[:8]}")
    log = StepLog(spark, cfg.log_dir)
    fact, m = curate_fact(spark, str(p), cfg, log, {}, spec)
    assert m["corrupt_rows"] == 2 and m["input_rows"] == 4
    assert sorted(r.encounter_id for r in fact.collect()) == [1, 3]
    bad = sorted(r.value for r in spark.read.text(cfg.bad_records_dir).collect())
    assert bad == ["2,b,extra", "4"]


def test_empty_input_gives_zero_metrics_and_null_score(spark, tmp_path):
    from curate.plans.fixtures import mapping_lines
    from curate.plans.silver import run_silver
    from curate.spec import ENCOUNTERS
    from conftest import SF_SMALL
    spec = ENCOUNTERS.restrict(["encounter_id", "age", "readmitted", "admission_type_id"])
    p = tmp_path / "empty.csv"
    p.write_text("encounter_id,age,readmitted,admission_type_id\n")
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), spec=spec,
                       database=f"t_{uuid.uuid4().hex[:8]}")
    out = run_silver(spark, cfg, str(p), mapping_lines(spark, SF_SMALL), spec=spec)
    rep = out["report"].first()
    assert rep.input_rows == 0 and rep.output_rows == 0 and rep.quality_score_pct is None
    assert rep.success_steps == rep.step_count == 10


def test_dimension_header_without_id_column_fails_the_step(spark, tmp_path):
    from curate.plans.silver import build_dims
    from curate.sources.literal import literal_rows
    lines = literal_rows(spark, [("m", 0, 0, "admission_type_id,desc"), ("m", 0, 1, "1,x")],
                         "file string, block long, idx long, line string")
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), database=f"t_{uuid.uuid4().hex[:8]}")
    log = StepLog(spark, cfg.log_dir)
    with pytest.raises(ValueError, match="admission_type_id,desc"):
        build_dims(spark, lines, cfg, log)
    assert [(r["step"], r["status"]) for r in log.records] == [
        ("silver_dim__create_dimensions", "FAILED")]


def test_written_report_document_shape(silver, spark):
    doc = spark.read.json(silver["log"].log_dir.replace("/_logs", "/data_quality_report")).first()
    assert set(doc.asDict()) == {"pipeline", "layer", "execution_timestamp", "total_steps",
                                 "steps_status", "data_quality_metrics"}
    m = doc.data_quality_metrics
    assert m.input_rows == silver["metrics"]["input_rows"]
    assert m.violations_by_constraint.asDict() == silver["metrics"]["violations"]
    assert m.quality_score_pct is not None


def test_report_requires_log_entries(spark, tmp_path):
    d = tmp_path / "log"
    (d / "run_id=r1").mkdir(parents=True)
    (d / "run_id=r1" / "part-0.txt").write_text("\n   \n")
    with pytest.raises(ValueError, match="No valid log entries"):
        read_step_log(spark, str(d), "r1", require=True)


def test_large_dimension_orphans_counted_after_write(spark, tmp_path, silver):
    from curate.plans.catalogue_io import write_csv
    from curate.plans.fixtures import encounters_raw, encounters_spec, mapping_lines
    from curate.plans.silver import run_silver
    from conftest import SF_SMALL
    raw = encounters_raw(spark, SF_SMALL)
    write_csv(raw, str(tmp_path / "csv"))
    spec = encounters_spec(raw)
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), spec=spec, broadcast_max_ids=0,
                       database=f"t_{uuid.uuid4().hex[:8]}")
    out = run_silver(spark, cfg, str(tmp_path / "csv"), mapping_lines(spark, SF_SMALL), spec=spec)
    assert out["metrics"]["fk_validation"] == silver["metrics"]["fk_validation"]


def test_rerun_into_same_folder_and_database(spark, tmp_path):
    from curate.plans.catalogue_io import write_encounter_archives
    from curate.plans.fixtures import encounters_raw, encounters_spec
    from curate.plans.run import run_all
    from conftest import SF_SMALL
    write_encounter_archives(spark, SF_SMALL, str(tmp_path / "zips"))
    spec = encounters_spec(encounters_raw(spark, SF_SMALL))
    db = f"t_{uuid.uuid4().hex[:8]}"
    first = run_all(spark, str(tmp_path / "run"), str(tmp_path / "zips"), spec=spec, database=db)
    second = run_all(spark, str(tmp_path / "run"), str(tmp_path / "zips"), spec=spec, database=db)
    assert first["silver"]["metrics"] == second["silver"]["metrics"]
    assert second["silver"]["fact"].count() == first["silver"]["metrics"]["saved"]["rows_saved"]
    runs = read_step_log(spark, str(tmp_path / "run" / "silver" / "_logs")).select("run_id").distinct()
    assert runs.count() == 2                       # history kept, runs told apart by run_id


def test_command_line_run(spark, tmp_path):
    import subprocess
    import sys
    from curate.plans.catalogue_io import write_encounter_archives
    from conftest import SF_SMALL
    write_encounter_archives(spark, SF_SMALL, str(tmp_path / "zips"))
    repo = __import__("os").path.dirname(__import__("os").path.dirname(__file__))
    r = subprocess.run([sys.executable, "-m", "curate.plans.run", str(tmp_path / "zips"),
                        str(tmp_path / "out"), f"cli_{uuid.uuid4().hex[:6]}", "--restrict"],
                       cwd=repo, capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stderr[-1500:]
    reports = [json.loads(line) for line in r.stdout.splitlines() if line.startswith("{")]
    silver = next(x["silver"] for x in reports if "silver" in x)
    bronze = next(x["bronze"] for x in reports if "bronze" in x)
    assert bronze["files_extracted"] >= 2 and silver["success_steps"] == 10
    assert silver["input_rows"] == encounters_rows(spark, SF_SMALL)


def encounters_rows(spark, sf_dir):
    from curate.plans.fixtures import encounters_raw
    return encounters_raw(spark, sf_dir).count()
