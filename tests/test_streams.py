"""Window drift in one streaming plan, and windows that account for every row."""

import os

import pytest
from fareweave.operators import drift as D
from fareweave.storage import materialize, scratch_home
from fareweave.streaming.drift import start_drift, window_drift
from fareweave.streaming.late import WindowTables, start_windows, write_batch
from fareweave.streaming.profile import baseline_profile, binned, windowed_profile
from pyspark.sql import functions as F

WIDTHS = {"x": 0.5, "few": 1.0, "gone": 1.0}
COLUMNS = ["x", "few", "gone", "kind", "never"]
ROWS = "t timestamp, x double, few double, gone double, kind string"


@pytest.fixture
def one_partition(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def rows(spark, windows, per_window, start="2024-01-01"):
    n = windows * per_window
    i = F.col("id")
    return spark.range(n).select(
        (F.lit(start).cast("timestamp") + F.make_dt_interval(hours=F.floor(i / per_window).cast("int"))).alias("t"),
        F.when(i % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(1000)) / 100 + i / n).alias("x"),
        (i % 3).cast("double").alias("few"),
        F.when(i % per_window < per_window * F.floor(i / per_window) / windows, 1.0).alias("gone"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) + 1).cast("int")).alias("kind"),
    )


@pytest.mark.parametrize("route", ["large", "small"])
def test_every_window_equals_the_batch_report(spark, tmp_path, route, one_partition):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    current, reference = rows(spark, 6, 60), rows(spark, 1, 500, "2023-01-01")
    current.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(current.schema).parquet(source)
    options = D.DriftOptions(route=route)
    profile = windowed_profile(stream, "t", WIDTHS, ["kind"], "1 hour", "0 seconds")
    baseline = baseline_profile(reference, WIDTHS, ["kind"])
    start_drift(profile, baseline, COLUMNS, out, str(tmp_path / "check"), options).awaitTermination()
    got = {(str(r.window_start), r.feature): r for r in spark.read.parquet(out).collect()}
    assert len(got) == 5 * len(COLUMNS)  # the last window is open
    for hour in range(5):
        start = f"2024-01-01 0{hour}:00:00"
        mine = binned(current.where(F.date_trunc("hour", "t") == F.lit(start).cast("timestamp")), WIDTHS)
        both = [df.withColumn("never", F.lit(None).cast("double")) for df in (binned(reference, WIDTHS), mine)]
        for r in D.drift_report(*both, COLUMNS, options).collect():
            g = got[start, r.feature]
            assert (g.test, g.position, g.reference_rows, g.current_rows) == (r.test, r.position, r.reference_rows, r.current_rows)
            assert (g.score is None) == (r.score is None) and g.drift_detected == r.drift_detected
            if r.score is not None:
                assert g.score == pytest.approx(r.score, abs=1e-9)


def test_a_thousand_windows_in_one_batch_and_no_collect(spark, tmp_path, one_partition, monkeypatch):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    current = rows(spark, 1001, 8)
    current.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(current.schema).parquet(source)
    profile = windowed_profile(stream, "t", WIDTHS, ["kind"], "1 hour", "0 seconds")
    baseline = materialize(baseline_profile(rows(spark, 1, 500), WIDTHS, ["kind"]), "baseline")
    report = window_drift(profile, baseline, COLUMNS)
    assert report.isStreaming and report.columns[0] == "window_start"

    def never(*_):
        raise AssertionError("collected")

    for name in ("collect", "first", "toPandas", "toArrow", "take"):
        monkeypatch.setattr(type(current), name, never)
    query = start_drift(profile, baseline, COLUMNS, out, str(tmp_path / "check"))
    query.awaitTermination()
    monkeypatch.undo()
    found = spark.read.parquet(out)
    assert found.count() == 1000 * len(COLUMNS) and found.select("window_start").distinct().count() == 1000
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 1


def test_batches_leave_nothing_in_the_scratch_folder(spark, tmp_path, one_partition):
    source, home = str(tmp_path / "in"), scratch_home(spark).removeprefix("file:")
    current = rows(spark, 50, 4)
    for i in range(50):
        hour = F.lit(f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00").cast("timestamp")
        if i % 10 == 0:  # fifty hours in fifty files, a few jobs
            current.where(F.floor((F.unix_timestamp("t") - F.unix_timestamp(hour)) / 3600).between(0, 9)).repartition(10).write.mode(
                "append"
            ).parquet(source)
    stream = spark.readStream.schema(current.schema).option("maxFilesPerTrigger", 1).parquet(source)
    profile = windowed_profile(stream, "t", WIDTHS, ["kind"], "1 hour", "0 seconds")
    baseline = baseline_profile(rows(spark, 1, 100), WIDTHS, ["kind"])
    report = window_drift(profile, baseline, COLUMNS)
    before = sorted(os.listdir(home))
    query = (
        report.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 49
    assert sorted(os.listdir(home)) == before


LATE = "id long, t string, x double"


def lot(spark, *entries):
    return spark.createDataFrame(entries, LATE).withColumn("t", F.col("t").cast("timestamp"))


def test_rows_in_are_rows_closed_open_and_late(spark, tmp_path, one_partition):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    lots = [
        lot(spark, (1, "2024-01-01 10:10:00", 1.2), (2, "2024-01-01 11:30:00", 2.2), (3, None, 1.0)),
        lot(spark, (4, "2024-01-01 10:59:00", 1.4), (5, "2024-01-01 11:40:00", None), (6, "2024-01-01 13:05:00", 9.0)),
        lot(spark, (7, "2024-01-01 11:00:00", 1.0), (8, "2024-01-01 12:30:00", 3.0), (9, "2024-01-01 10:00:00", 3.0)),
        lot(spark, (10, "2024-01-01 17:00:00", 1.0)),
    ]
    for part in lots:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        start_windows(stream, "t", {"x": 1.0}, [], out, str(tmp_path / "check"), "1 hour", "30 minutes").awaitTermination()
    tables = WindowTables(spark, out)
    late = {(r.id, r.reason, str(r.window_start)) for r in tables.late().collect()}
    # The second lot ends at 12:35 by its watermark: windows up to 12:00 are closed then.
    assert late == {(3, "no_time", "None"), (7, "late", "2024-01-01 11:00:00"), (9, "late", "2024-01-01 10:00:00"),
                    (4, "late", "2024-01-01 10:00:00")}
    rows_of = lambda df: {str(r.window_start): r.n for r in df.where("feature = '_rows'").collect()}
    assert rows_of(tables.closed()) == {f"2024-01-01 {h}:00:00": n for h, n in ((10, 1), (11, 2), (12, 1), (13, 1))}
    assert rows_of(tables.open()) == {"2024-01-01 17:00:00": 1}
    last = tables.progress().orderBy(F.desc("batch_id")).first()
    assert (last.rows_in, last.rows_kept, last.rows_late, last.rows_untimed) == (10, 6, 3, 1)
    x = {(str(r.window_start), r.x): r.n for r in tables.closed().where("feature = 'x'").collect()}
    assert x == {("2024-01-01 10:00:00", 1.0): 1, ("2024-01-01 11:00:00", 2.0): 1, ("2024-01-01 12:00:00", 3.0): 1, ("2024-01-01 13:00:00", 9.0): 1}


def test_a_repeated_batch_changes_nothing_and_old_states_go(spark, tmp_path, one_partition):
    tables = WindowTables(spark, str(tmp_path / "out"))

    def write(i, *entries):
        write_batch(tables, lot(spark, *entries), i, "t", {"x": 1.0}, [], "1 hour", "0 seconds")

    def state():
        return [sorted(map(str, df.collect())) for df in (tables.closed(), tables.open(), tables.late(), tables.progress())]

    write(0, (1, "2024-01-01 10:10:00", 1.2))
    write(1, (2, "2024-01-01 11:10:00", 1.2), (3, "2024-01-01 09:10:00", 1.2))
    write(2, (4, "2024-01-01 10:20:00", 1.2), (5, "2024-01-01 12:20:00", 1.2))
    before = state()
    write(2, (4, "2024-01-01 10:20:00", 1.2), (5, "2024-01-01 12:20:00", 1.2))
    assert state() == before
    states = [d for d in range(3) if os.path.exists(f"{tables.folder('windows', d)}/closed=false")]
    assert states == [1, 2]
    write(3, (6, None, None))
    assert tables.progress().count() == 4 and tables.open().where("feature = '_rows'").count() == 1


def test_before_the_first_batch(spark, tmp_path):
    tables = WindowTables(spark, str(tmp_path / "none"))
    assert tables.closed().count() == tables.open().count() == tables.progress().count() == 0
