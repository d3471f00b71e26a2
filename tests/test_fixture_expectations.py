"""Metric values FIXTURES.md §4 records for the dirty encounter extract at sf0.01."""

import pytest

from curate.plans.catalogue import QUERIES as Q

from conftest import SF_MID


@pytest.fixture(scope="module")
def got(spark):
    return {
        "casts": {r.column: r.failed_rows for r in Q["cast_failure_profile"](spark, SF_MID).collect()},
        "dedupe": tuple(Q["dedupe_stats"](spark, SF_MID).first()),
        "nulls": {r.column: r.null_count for r in Q["null_profile"](spark, SF_MID).collect()},
        "fks": {r.fk: r.orphaned_fact_rows for r in Q["fk_orphan_counts"](spark, SF_MID).collect()},
        "rules": {r.constraint: r.violations for r in Q["rule_violations"](spark, SF_MID).collect()},
        "share": {(r.age_group, r.readmitted): (r["count"], r.total, r.percentage)
                  for r in Q["readmission_share"](spark, SF_MID).collect()},
    }


def test_cast_failures_and_dedupe(got):
    assert got["casts"] == {"encounter_id": 17, "num_lab_procedures": 173}
    assert got["dedupe"] == (15300, 14985, 315)


def test_nulls_after_dedupe(got):
    assert got["nulls"] == {"encounter_id": 1, "race": 2998, "age": 144, "admission_type_id": 67,
                            "num_lab_procedures": 168, "diag_1": 882, "metformin": 2498,
                            "diabetesMed": 4995}


def test_fk_orphans_and_rules(got):
    assert got["fks"] == {"admission_type_id": 71, "discharge_disposition_id": 600,
                          "admission_source_id": 2997}
    assert got["rules"] == {"time_in_hospital_positive": 998,
                            "num_lab_procedures_non_negative": 247,
                            "number_diagnoses_positive": 1498, "age_valid_range": 148,
                            "gender_valid_values": 0, "max_glu_serum_valid_values": 48,
                            "metformin_valid_values": 2498, "change_valid_values": 3746,
                            "diabetesMed_valid_values": 0, "readmitted_valid_values": 1665}


def test_readmission_share(got):
    s = got["share"]
    assert s[("adult", "<30")] == (851, 7408, 11.49)
    assert s[("adult", ">30")] == (840, 7408, 11.34)
    assert s[("adult", "LATER")] == (846, 7408, 11.42)
    assert s[("adult", "NO")] == (4871, 7408, 65.75)
    assert s[("pediatric", "NO")] == (1998, 2925, 68.31)
    assert s[("senior", ">30")] == (519, 4652, 11.16)
    assert s[("senior", "NO")] == (3120, 4652, 67.07)
