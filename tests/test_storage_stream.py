"""Files, and streams against their batch twins."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fareweave.operators import drift as D
from fareweave.operators.score import formula_scorer, score_requests
from fareweave.plans import queries as Q
from fareweave.sources import files
from fareweave.sources.events import hourly_supply, read_events, rides_from_events
from fareweave.storage import materialize, scratch_root
from fareweave.streaming.drift import start_drift
from fareweave.streaming.profile import baseline_profile, start_profile, windowed_profile
from fareweave.streaming.scoring import start_scoring


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rides_keep_every_event(spark, small, rides):
    events = read_events(spark, small)
    assert same(rides, rides_from_events(events, materialize(hourly_supply(events), "hours")))
    assert rides.count() == events.count()
    assert hourly_supply(events).agg(F.sum("passenger_demand")).first()[0] == events.count()


def test_scratch_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == configured
    df = spark.createDataFrame([], "a int, b string")
    assert materialize(df, "empty").schema == df.schema


def test_readers_and_writers(spark, rides, tmp_path):
    path = str(tmp_path / "rides")
    files.write_table(rides, path, "csv")
    assert same(files.read_rides(spark, path), rides)
    with pytest.raises(files.MissingTable):
        files.read_baseline(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        files.read_table(spark, path, fmt="csv")


def test_json_requests_and_documents(spark, tmp_path):
    path = str(tmp_path / "req")
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write(json.dumps({"hour_of_day": 18, "base_fare": 8.5, "weather_condition": "rain"}) + "\n")
    row = files.read_requests(spark, path).first()
    assert row["hour_of_day"] == "18" and row["temperature"] is None
    body = spark.createDataFrame([(1, '{"hour_of_day": 3, "is_weekend": true}')], "id int, body string")
    assert files.parse_requests(body, "body").first()["is_weekend"] == "true"
    doc = spark.createDataFrame([('{"drift_scores": {"a": {"drift_detected": true, "drift_score": 0.25}}}',), ("{}",)], "d string")
    found = doc.select(*files.document_score(F.col("d"), "a")).collect()
    assert [tuple(r) for r in found] == [(True, 0.25), (False, 0.0)]
    label = spark.createDataFrame([("Data drift detected. Drift score: 0.115",), ("none",)], "t string")
    assert [r[0] for r in label.select(files.label_score(F.col("t"))).collect()] == [0.115, None]


def stream(spark, folder, schema, files_per_batch=None):
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def test_scoring_stream_equals_batch(spark, rides, tmp_path):
    requests = Q.raw_requests(rides).repartition(4)
    source = str(tmp_path / "in")
    requests.write.parquet(source)
    scored, rejected, check = (str(tmp_path / n) for n in ("scored", "rejected", "check"))
    for _ in range(2):
        query = start_scoring(stream(spark, source, requests.schema, 1), formula_scorer, scored, rejected, check)
        query.awaitTermination()
    batch_scored, batch_rejected = score_requests(requests, formula_scorer)
    assert same(batch_scored, spark.read.parquet(scored).drop("batch_id"))
    assert same(batch_rejected, spark.read.parquet(rejected).drop("batch_id"))


def test_late_rows_are_dropped_and_open_windows_kept_back(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "t timestamp_ntz, x double"

    def add(name, rows):
        df = spark.createDataFrame(rows, "t string, x double").select(F.col("t").cast("timestamp_ntz").alias("t"), "x")
        df.coalesce(1).write.mode("append").parquet(source)

    def run():
        profile = windowed_profile(stream(spark, source, schema, 1), "t", {"x": 1.0}, [])
        start_profile(profile, out, str(tmp_path / "check")).awaitTermination()

    add("a", [("2024-01-01 10:00:00", 1.5), ("2024-01-01 11:00:00", 1.7), ("2024-01-02 12:00:00", 2.5)])
    run()
    add("b", [("2024-01-01 12:00:00", 1.6), ("2024-01-03 12:00:00", 3.5)])
    run()
    rows = spark.read.parquet(out).where("feature = 'x'").collect()
    got = sorted((r["window_start"].day, r["x"], r["n"]) for r in rows)
    assert got == [(1, 1.0, 2), (2, 2.0, 1)]


def test_stream_drift_equals_batch_drift(spark, small, tmp_path):
    events = read_events(spark, small)
    parts = Q.event_columns()
    columns = [*Q.STREAM_WIDTHS, *Q.STREAM_TEXT]
    rides = events.select(*[parts[c].alias(c) for c in ["timestamp", *columns]])
    baseline = rides.where("timestamp < timestamp_ntz'2024-01-16'")
    out = str(tmp_path / "drift")
    options = D.DriftOptions(route="large")
    query = start_drift(
        Q._window_stream(spark, small),
        baseline_profile(baseline, Q.STREAM_WIDTHS, Q.STREAM_TEXT),
        columns,
        out,
        str(tmp_path / "check"),
        options,
    )
    query.awaitTermination()
    got = {r["feature"]: r["score"] for r in spark.read.parquet(out).where("window_start = timestamp'2024-01-20'").collect()}
    day = rides.where("timestamp >= timestamp_ntz'2024-01-20' and timestamp < timestamp_ntz'2024-01-21'")
    from fareweave.streaming.profile import binned

    batch = D.drift_report(binned(baseline, Q.STREAM_WIDTHS), binned(day, Q.STREAM_WIDTHS), columns, options)
    expected = {r["feature"]: r["score"] for r in batch.collect()}
    assert got.keys() == expected.keys()
    for f in got:
        assert got[f] == pytest.approx(expected[f], abs=1e-9)


def test_events_without_a_time_are_kept(spark, small):
    events = read_events(spark, small)
    lost = events.withColumn("ts", F.when(F.col("event_id") != 3, F.col("ts")))
    out = rides_from_events(lost)
    assert out.count() == 1000
    row = out.where("ride_id = 3").first()
    assert row["passenger_demand"] is None and row["price_multiplier"] is None
