"""The full 50-column encounter specification end to end on a small hand-made CSV."""

import json
import uuid

from curate.plans.silver import SilverConfig, run_silver
from curate.sources.literal import literal_rows
from curate.spec import ENCOUNTER_COLUMNS, MEDICATIONS


def _row(i, **over):
    base = {c: "No" for c in MEDICATIONS}
    base.update({
        "encounter_id": str(1000 + i), "patient_nbr": str(500 + i % 2), "race": "Caucasian",
        "gender": "Female", "age": "[70-80)", "weight": "?", "admission_type_id": "1",
        "discharge_disposition_id": "1", "admission_source_id": "7", "time_in_hospital": "3",
        "payer_code": "?", "medical_specialty": "Cardiology", "num_lab_procedures": "41",
        "num_procedures": "0", "num_medications": "12", "number_outpatient": "0",
        "number_emergency": "0", "number_inpatient": "0", "diag_1": "250.83", "diag_2": "276",
        "diag_3": "V27", "number_diagnoses": "9", "max_glu_serum": "None", "A1Cresult": ">7",
        "change": "Ch", "diabetesMed": "Yes", "readmitted": "NO"})
    base.update(over)
    return ",".join(base[c] for c in ENCOUNTER_COLUMNS)


def test_full_spec_run(spark, tmp_path):
    lines = [",".join(ENCOUNTER_COLUMNS),
             _row(1), _row(2, insulin="Up", **{"glyburide-metformin": "Steady"}),
             _row(3, gender="Unknown/Invalid", readmitted=">30", age="[0-10)", A1Cresult="Norm"),
             _row(4, race="AfricanAmerican", metformin="maybe", time_in_hospital="0",
                  num_procedures="-1"),
             _row(4),                                              # duplicate key, not kept
             _row(5, admission_type_id="9", num_medications="x12")]
    p = tmp_path / "diabetic_data.csv"
    p.write_text("\r\n".join(lines) + "\r\n")
    mapping = literal_rows(spark, [
        ("m", 0, 0, "admission_type_id,description"), ("m", 0, 1, "1,Emergency"),
        ("m", 1, 0, ","),
        ("m", 2, 0, "discharge_disposition_id,description"), ("m", 2, 1, '1,"Discharged, home"'),
        ("m", 3, 0, ","),
        ("m", 4, 0, "admission_source_id,description"), ("m", 4, 1, " 7,Emergency Room")],
        "file string, block long, idx long, line string")
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), database=f"f_{uuid.uuid4().hex[:8]}")
    out = run_silver(spark, cfg, str(p), mapping)
    recs = {r["step"]: r["payload"] for r in out["log"].records}

    assert recs["silver_fact_ingest__load_csv"]["rows"] == 6
    assert recs["silver_fact_ingest__load_csv"]["cols"] == 50
    schema = recs["silver_fact_ingest__hard_schema_exact"]
    assert schema["schema_exact_match"] is True and schema["columns"] == 50
    assert schema["casting_failures_by_column"] == {
        "num_medications": {"failed_rows": 1, "target_type": "int", "failure_rate_pct": 16.67}}
    assert recs["silver_validation__duplicates"]["duplicates_removed"] == 1
    assert recs["silver_transformation__feature_engineering"]["categorical_cols_standardized"] == 30
    assert recs["silver_transformation__feature_engineering"]["string_cols_trimmed"] == 37
    fk = recs["silver_validation__referential_integrity"]["fk_validation"]
    assert fk["admission_type_id"]["orphaned_fact_rows"] == 1
    assert fk["admission_source_id"] == {"valid_dim_values": 1, "orphaned_fact_rows": 0}
    v = recs["silver_validation__business_constraints"]["violations_by_constraint"]
    assert len([k for k in v if k.endswith("_valid_values") and k.split("_valid")[0] in MEDICATIONS]) == 1
    assert v["metformin_valid_values"] == 1                # only medications that fired
    assert v["time_in_hospital_positive"] == 1 and v["num_procedures_non_negative"] == 1
    assert v["gender_valid_values"] == 0 and v["A1Cresult_valid_values"] == 0
    assert len(v) == 15 + 1                                 # 15 always-reported rules + metformin
    fact = {r.encounter_id: r for r in out["fact"].collect()}
    assert fact[1003].gender is None and fact[1003].age_group == "pediatric"
    assert fact[1003].readmitted_flag == 1 and fact[1001].change == "change"
    assert fact[1002].insulin == "Up" and fact[1001].diag_1 == "25083"
    assert fact[1004].race == "Africanamerican"            # min row kept: 'AfricanAmerican' < 'Caucasian'
    rep = out["report"].first()
    assert json.loads(rep.violations_by_constraint) == v and rep.output_rows == 5
