"""Incremental curation: micro-batches, per-batch metrics, restart without duplicates."""

from pyspark.sql import functions as F

from curate.plans.catalogue import QUERIES
from curate.plans.catalogue_io import write_csv
from curate.plans.fixtures import encounters_raw, encounters_spec
from curate.streaming.incremental import read_batch_log, read_curated, start_curation

from conftest import SF_SMALL


def test_stream_curation_batches_and_restart(spark, tmp_path):
    raw = encounters_raw(spark, SF_SMALL)
    spec = encounters_spec(raw)
    land, out = str(tmp_path / "landing"), str(tmp_path / "out")
    ckpt, logs = str(tmp_path / "ckpt"), str(tmp_path / "logs")
    write_csv(raw.repartition(4), land)
    q, log = start_curation(spark, land, spec, out, ckpt, logs, names=raw.columns,
                            max_files_per_trigger=1)
    q.awaitTermination()
    batches = read_batch_log(spark, logs).collect()
    assert len(batches) >= 4
    total = raw.count()
    assert read_curated(spark, out).count() == total
    import json
    per_batch = [json.loads(r.payload) for r in batches]
    assert sum(p["rows"] for p in per_batch) == total
    nulls_diag = sum(p["missing_values"].get("diag_1", 0) for p in per_batch)
    assert nulls_diag == QUERIES["hard_schema"](spark, SF_SMALL).where(F.col("diag_1").isNull()).count()

    # a restart over the same checkpoint processes nothing new and duplicates nothing
    q2, _ = start_curation(spark, land, spec, out, ckpt, logs, names=raw.columns)
    q2.awaitTermination()
    assert read_curated(spark, out).count() == total


def test_stream_dedupe_first_is_stateful_across_batches(spark, tmp_path):
    from curate.spec import ENCOUNTERS
    spec = ENCOUNTERS.restrict(["encounter_id", "race"])
    land = tmp_path / "landing"
    land.mkdir()
    for i, rows in enumerate([["1,a", "2,b", "1,c"], ["2,d", "3,e"], ["3,f", "4,g"]]):
        (land / f"part-{i}.csv").write_text("encounter_id,race\n" + "\n".join(rows) + "\n")
    q, _ = start_curation(spark, str(land), spec, str(tmp_path / "out"), str(tmp_path / "ck"),
                          str(tmp_path / "logs"), names=["encounter_id", "race"],
                          dedupe="first", max_files_per_trigger=1)
    q.awaitTermination()
    got = sorted(r.encounter_id for r in read_curated(spark, str(tmp_path / "out")).collect())
    assert got == [1, 2, 3, 4]                 # later duplicates dropped across micro-batches


def test_replayed_epoch_is_not_double_counted(spark, tmp_path, monkeypatch):
    import json
    import pytest
    import curate.streaming.incremental as inc
    raw = encounters_raw(spark, SF_SMALL)
    spec = encounters_spec(raw)
    land, out = str(tmp_path / "landing"), str(tmp_path / "out")
    ckpt, logs = str(tmp_path / "ckpt"), str(tmp_path / "logs")
    write_csv(raw.repartition(3), land)
    original, state = inc.batch_writer, {"failed": False}

    def flaky(spec_, out_dir, log_dir):
        inner = original(spec_, out_dir, log_dir)

        def write(df, epoch_id):
            inner(df, epoch_id)                 # rows and metrics written ...
            if epoch_id == 1 and not state["failed"]:
                state["failed"] = True
                raise RuntimeError("crash before the epoch commits")   # ... but not committed
        return write

    monkeypatch.setattr(inc, "batch_writer", flaky)
    q, _ = start_curation(spark, land, spec, out, ckpt, logs, names=raw.columns,
                          max_files_per_trigger=1)
    with pytest.raises(Exception):
        q.awaitTermination()
    q2, _ = start_curation(spark, land, spec, out, ckpt, logs, names=raw.columns,
                           max_files_per_trigger=1)
    q2.awaitTermination()                       # epoch 1 is replayed, then the rest
    total = raw.count()
    assert read_curated(spark, out).count() == total
    records = read_batch_log(spark, logs).collect()
    assert sorted(r.epoch for r in records) == list(range(len(records)))
    assert sum(json.loads(r.payload)["rows"] for r in records) == total
