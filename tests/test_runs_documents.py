"""Runs that can be repeated, and documents that cannot be read."""

import json
import os

import pytest
from fareweave.operators.quality import split_requests
from fareweave.plans.pipeline import run_pipeline
from fareweave.schema import MALFORMED
from fareweave.sources import files
from fareweave.storage import scratch_home
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

GOOD = {
    "hour_of_day": 18, "day_of_week": 2, "is_weekend": False, "passenger_demand": 50, "driver_availability": 10,
    "weather_condition": "rain", "temperature": 12.5, "visibility_km": 5.0, "base_fare": 8.5,
}
TEXT = json.dumps(GOOD)
SPOILT = [
    "", " ", "{", "}", TEXT[:-1], TEXT[1:], f"[{TEXT}]", "[]", "42", '"text"', "null", "true", TEXT + " x", TEXT + TEXT, TEXT + "," + TEXT,
    TEXT + "],[" + TEXT, TEXT + '},{"d":' + TEXT, TEXT + ',"e":' + TEXT, TEXT + "]", "[" + TEXT, TEXT.replace('"', "'"), "{hour_of_day: 1}",
    '{"hour_of_day": 1,}', '{"hour_of_day" 1}', '{"a": [1, 2}', '{"a": "\\x"}', None,
]


def parsed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")
    return {r.id: r for r in files.parse_requests(df, "body").collect()}


def test_spoilt_documents_keep_their_text(spark):
    for i, row in parsed(spark, SPOILT).items():
        assert row[MALFORMED] == (SPOILT[i] or ""), SPOILT[i]
        assert row["hour_of_day"] is None and row["base_fare"] is None


def test_odd_documents_that_are_whole(spark):
    texts = [
        TEXT, f"  {TEXT}\n", "{}", '{"hour_of_day": 1, "hour_of_day": 2}', '{"x": {"d": 1}, "hour_of_day": null}',
        '{"weather_condition": "a } ] , { \\" b"}', '{"hour_of_day": {"deep": [1, 2]}}',
    ]
    rows = parsed(spark, texts)
    assert all(r[MALFORMED] is None for r in rows.values())
    assert [rows[i]["hour_of_day"] for i in range(7)] == ["18", "18", None, "2", None, None, '{"deep":[1,2]}']
    assert rows[5]["weather_condition"] == 'a } ] , { " b'


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[]",:1a d\\', max_size=14), min_size=1, max_size=40))
def test_what_a_strict_parser_takes(spark, texts):
    def whole(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    rows = parsed(spark, texts)
    for i, text in enumerate(texts):
        assert (rows[i][MALFORMED] is None) == whole(text), text


def test_quarantine_names_the_reason_and_keeps_the_text(spark, tmp_path):
    folder = tmp_path / "requests"
    folder.mkdir()
    bad = {**GOOD, "weather_condition": "hurricane"}
    (folder / "a.json").write_text("\n".join([TEXT, TEXT[:40], "", json.dumps(bad), f"[{TEXT}]"]) + "\n")
    accepted, rejected = split_requests(files.read_requests(spark, str(folder)))
    assert accepted.count() == 1 and MALFORMED not in accepted.columns
    got = {r[MALFORMED]: r.errors for r in rejected.collect()}
    assert got == {TEXT[:40]: ["document:malformed"], f"[{TEXT}]": ["document:malformed"], None: ["weather_condition:range"]}


def test_runs_replace_their_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, x string")
    for run_id, rows in (("1", df), ("1", df.where("n = 1")), ("01", df), ("a/b=c", df)):
        files.write_run(rows, path, run_id)
    found = files.read_runs(spark, path)
    assert sorted((r.run, r.n) for r in found.collect()) == [("01", 1), ("01", 2), ("1", 1), ("a/b=c", 1), ("a/b=c", 2)]
    with pytest.raises(ValueError):
        files.write_run(df, path, "")


def test_drift_history_by_time_or_id(spark, tmp_path):
    path = str(tmp_path / "history")

    def add(day, rows, run_id=None):
        summary = spark.createDataFrame([(f"2024-01-0{day} 10:00:00", rows)], "t string, rows int")
        files.append_drift_history(summary.selectExpr("cast(t as timestamp) as run_time", "rows"), path, run_id)

    for day, rows in ((1, 1), (1, 2), (2, 3)):
        add(day, rows)
    add(2, 4, "other")
    add(2, 5, "other")
    add(1, 6, "other")
    got = sorted((str(r.run_date), r.run, r.rows) for r in files.read_drift_history(spark, path).collect())
    assert got == [
        ("2024-01-01", "2024-01-01T10-00-00.000000", 2), ("2024-01-01", "other", 6),
        ("2024-01-02", "2024-01-02T10-00-00.000000", 3), ("2024-01-02", "other", 5),
    ]


def test_a_pipeline_run_twice_with_one_id_leaves_one_copy(spark, rides, tmp_path):
    out = str(tmp_path / "out")
    linear = [{"name": "linear_regression", "kind": "LinearRegression", "params": {}}]
    before = sorted(os.listdir(scratch_home(spark).removeprefix("file:")))
    trained = run_pipeline(rides, out, linear, run_id="a")
    assert sorted(os.listdir(scratch_home(spark).removeprefix("file:"))) == before
    assert trained.best_run().name == "linear_regression" and trained.metrics.count() == 2
    once = files.read_runs(spark, f"{out}/run_log").count()
    run_pipeline(rides, out, linear, run_id="a")
    assert files.read_runs(spark, f"{out}/run_log").count() == once
    run_pipeline(rides, out, linear, run_id="b")
    runs = files.read_runs(spark, f"{out}/runs").groupBy("run").count().collect()
    assert {(r.run, r["count"]) for r in runs} == {("a", 1), ("b", 1)}
    assert files.read_runs(spark, f"{out}/run_log").count() == 2 * once
