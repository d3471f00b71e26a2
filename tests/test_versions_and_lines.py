"""Published versions, one-pass split, pattern histograms, compaction, resumed runs, archive lines."""

import json
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from curate.operators.metrics import counts_from_masks, counts_long, mask_histogram, patterns
from curate.plans.sinks import ensure_db, publish_table, roll_back, table_versions
from curate.plans.steplog import StepLog, compact_log
from curate.sources import archive_lines as A
from curate.sources.csv import divert_corrupt, read_permissive_csv
from curate.sources.steplog import read_step_log


def test_a_failed_publish_leaves_the_old_rows(spark, tmp_path):
    db = f"p_{uuid.uuid4().hex[:8]}"
    ensure_db(spark, db, str(tmp_path / "db"))
    name, root = f"{db}.t", str(tmp_path / "t")
    publish_table(spark.range(10).toDF("id"), name, root)
    stop = spark.range(1000).repartition(8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        publish_table(stop, name, root)
    assert spark.table(name).count() == 10
    info = publish_table(spark.table(name).where("id < 4"), name, root)          # reads the table it overwrites
    assert info == {"table": name, "rows_saved": 4, "columns_saved": 1, "format": "parquet"}
    assert spark.table(name).count() == 4
    roll_back(spark, name)
    assert spark.table(name).count() == 10
    publish_table(spark.createDataFrame([(1, "x")], "id long, s string"), name, root)   # other columns
    assert spark.table(name).collect() == [(1, "x")] and table_versions(spark, name)[1] is not None
    with pytest.raises(ValueError):
        publish_table(spark.range(1), f"{db}.u", str(tmp_path / "u"))
        roll_back(spark, f"{db}.u")


def test_corrupt_rows_are_split_in_one_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x,y\n1,2\n3,4,5\n6,7\n")
    (tmp_path / "in" / "b.csv").write_text("x,y\n8\n?,9\n")
    raw = read_permissive_csv(spark, str(tmp_path / "in"), ["x", "y"])
    good, n = divert_corrupt(raw, str(tmp_path / "staged"), str(tmp_path / "bad"))
    assert n == 2 and good.columns == raw.columns
    assert sorted((r.x, r.y) for r in good.collect()) == [("1", "2"), ("6", "7"), ("?", "9")]
    assert "csv" not in good._jdf.queryExecution().executedPlan().toString().lower()      # the input isn't read again
    origin = {r.record: (r.file.rsplit("/", 1)[1], r.block) for r in spark.read.parquet(str(tmp_path / "bad_origin")).collect()}
    assert origin == {"3,4,5": ("a.csv", 0), "8": ("b.csv", 0)}
    none, n = divert_corrupt(raw.where("x = '1'"), str(tmp_path / "s2"), str(tmp_path / "b2"))
    assert n == 0 and none.count() == 1 and spark.read.text(str(tmp_path / "b2")).count() == 0


def test_patterns_over_several_masks(spark):
    df = spark.range(200).toDF("i")
    named = [(f"d{k}", F.pmod("i", F.lit(k)) == 0) for k in range(2, 132)]               # three masks
    histogram = mask_histogram(df, named)
    names = [n for n, _ in named]
    assert {f for f in histogram.columns} == {"_mask0", "_mask1", "_mask2", "_rows"}
    got = {r.name: r.value for r in counts_from_masks(histogram, names).collect()}
    assert got == {r.name: r.value for r in counts_long(df, named, total_col=None).collect()}
    seen = {r.pattern: r.rows for r in patterns(histogram, names).collect()}
    want = {}
    for i in range(200):
        key = ",".join(f"d{k}" for k in range(2, 132) if i % k == 0)
        want[key] = want.get(key, 0) + 1
    assert seen == want
    assert counts_from_masks(mask_histogram(df.where("false"), named), names).agg(F.sum("value")).first()[0] == 0


def test_compacted_log_reads_the_same(spark, tmp_path):
    d, c = str(tmp_path / "log"), str(tmp_path / "compact")
    for run, status in (("a", "SUCCESS"), ("b", "FAILED"), ("c", "SUCCESS")):
        log = StepLog(spark, d, run)
        log.write("one", "SUCCESS", {"n": 1, "nested": {"k": [1, 2]}})
        log.write("last", status, {"n": 2})
    before = sorted(map(repr, read_step_log(spark, d).select("run_id", "seq", "step", "status", "payload").collect()))
    assert compact_log(spark, d, c, ("last",)) == ["a", "c"]
    assert compact_log(spark, d, c, ("last",)) == ["a", "c"]
    after = read_step_log(spark, d, compacted=c)
    assert sorted(map(repr, after.select("run_id", "seq", "step", "status", "payload").collect())) == before
    StepLog(spark, d, "b").write("last", "SUCCESS", {"n": 3})
    assert compact_log(spark, d, c, ("last",)) == ["a", "b", "c"]
    assert read_step_log(spark, d, "b", compacted=c).count() == 3
    assert read_step_log(spark, d, compacted=str(tmp_path / "none")).count() == 7


def test_resumed_run_runs_only_what_is_missing(spark, tmp_path):
    from dataclasses import replace

    from curate.plans.catalogue_io import write_csv
    from curate.plans.fixtures import encounters_raw, encounters_spec, mapping_lines
    from curate.plans.silver import STEP_DIMS, STEP_SAVE, SilverConfig, run_silver
    from conftest import SF_SMALL

    raw = encounters_raw(spark, SF_SMALL)
    write_csv(raw, str(tmp_path / "csv"))
    mapping_lines(spark, SF_SMALL).write.parquet(str(tmp_path / "map"))
    lines, spec = spark.read.parquet(str(tmp_path / "map")), encounters_spec(raw)
    cfg = SilverConfig(base_dir=str(tmp_path / "run"), spec=spec, database=f"r_{uuid.uuid4().hex[:8]}")
    with pytest.raises(Exception, match="no_such"):
        run_silver(spark, cfg, str(tmp_path / "csv"), lines, spec=replace(spec, key=("no_such",)), run_id="r", resume=True)
    versions = table_versions(spark, cfg.table("dim_admission_type"))
    out = run_silver(spark, cfg, str(tmp_path / "csv"), lines, spec=spec, run_id="r", resume=True)
    assert out["skipped"] == [STEP_DIMS] and table_versions(spark, cfg.table("dim_admission_type")) == versions
    again = run_silver(spark, cfg, str(tmp_path / "csv"), lines, spec=spec, run_id="r", resume=True)
    assert again["skipped"] == [STEP_DIMS, STEP_SAVE]
    drop = ("execution_timestamp", "total_steps")
    plain = run_silver(spark, replace(cfg, base_dir=str(tmp_path / "plain"), database=f"r_{uuid.uuid4().hex[:8]}"), str(tmp_path / "csv"), lines, spec=spec)

    def told(x):
        row = x["report"].drop(*drop).first().asDict(recursive=True)
        row["output_table"] = row["output_table"].split(".")[1]
        return row
    assert told(out) == told(plain) == told(again)
    (tmp_path / "csv" / "part-new.csv").write_text(",".join(raw.columns) + "\n" + ",".join(["9"] * len(raw.columns)) + "\n")
    changed = run_silver(spark, cfg, str(tmp_path / "csv"), lines, spec=spec, run_id="r", resume=True)
    assert changed["skipped"] == [STEP_DIMS] and changed["metrics"]["input_rows"] == out["metrics"]["input_rows"] + 1
    assert json.loads(changed["log"].records[0]["payload"] if isinstance(changed["log"].records[0]["payload"], str) else "{}") == {}


def test_archive_lines_in_bounded_batches(spark, tmp_path, monkeypatch):
    body = "a\r\nb\n\nlong " + "x" * 5000 + "\rlast"
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("d/", b"")
        zf.writestr("d/t.txt", body.encode() + b"\xff")
        zf.writestr("d/empty.txt", b"")
        zf.writestr("other.txt", b"no\n")
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    want = [(i, s) for i, s in enumerate(["a", "b", "", "long " + "x" * 5000, "last�"])]
    got = A.read_archive_lines(spark, str(tmp_path), ("t.txt", "empty.txt"))
    assert sorted((r.line_no, r.line) for r in got.collect()) == want and got.select("member_path").distinct().collect() == [("d/t.txt",)]
    A.register(spark)
    source = spark.read.format("archive_lines").option("members", "t.txt,empty.txt").load(str(tmp_path))
    assert sorted((r.line_no, r.line) for r in source.collect()) == want
    assert spark.read.format("archive_lines").load(str(tmp_path / "none.zip")).count() == 0


def test_a_large_member_is_read_in_small_batches(tmp_path):
    """100 MB in one member: no batch holds more than the bound and a line."""
    line = b"0123456789" * 10 + b"\n"
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf, zf.open("big.txt", "w") as f:
        for _ in range(1000):
            f.write(line * 1000)
    with zipfile.ZipFile(tmp_path / "big.zip") as zf:
        batches = [(b.num_rows, b.nbytes) for b in A.member_lines("big.zip", zf, 0)]
    assert sum(n for n, _ in batches) == 1_000_000 and max(n for n, _ in batches) <= A.BATCH_LINES
    assert max(size for _, size in batches) < 3 * A.BATCH_CHARS


def test_partitions_of_the_source_follow_bytes(spark, tmp_path, monkeypatch):
    """Small archives share a partition; a larger one's members are spread over several, each member once."""
    want = []
    for a in range(30):
        with zipfile.ZipFile(tmp_path / f"small{a:02}.zip", "w") as zf:
            for m in range(20):
                zf.writestr(f"{m}/t.txt", f"{a} {m}\nend\n")
                want += [(f"small{a:02}.zip", f"{m}/t.txt", 0, f"{a} {m}"), (f"small{a:02}.zip", f"{m}/t.txt", 1, "end")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as zf:
        for m in range(40):
            zf.writestr(f"{m}/t.txt", "y" * 3000)
            zf.writestr(f"{m}/other.txt", "no")
            want.append(("z.zip", f"{m}/t.txt", 0, "y" * 3000))
    monkeypatch.setattr(A, "PARTITION_BYTES", 20_000)
    reader = A.ArchiveLinesReader({"path": str(tmp_path), "members": "t.txt"})
    parts = reader.partitions()
    assert len(parts) < 30 and sum(a[0].endswith("/z.zip") for p in parts for a in p.archives) >= 6
    rows = [(r["path"].rsplit("/", 1)[1], r["member_path"], r["line_no"], r["line"]) for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(rows) == sorted(want)
    assert max(sum(1 for _ in reader.read(p)) for p in parts) <= 3
    A.register(spark)
    source = spark.read.format("archive_lines").option("members", "t.txt").load(str(tmp_path))
    assert source.rdd.getNumPartitions() < 30
    assert sorted((r.path.rsplit("/", 1)[1], r.member_path, r.line_no, r.line) for r in source.collect()) == sorted(want)
