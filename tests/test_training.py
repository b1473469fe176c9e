"""Training against closed forms, model selection, and the saved predictor."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareweave import config
from fareweave.operators.score import RAW
from fareweave.plans.predictor import PricePredictor
from fareweave.plans.prepare import FittedState, prepare
from fareweave.plans.queries import raw_requests
from fareweave.plans.training import importances, predict_with, run_log, train_all, train_model
from fareweave.sources import files


@pytest.fixture(scope="module")
def prepared(spark, rides):
    return prepare(rides)


@pytest.fixture(scope="module")
def trained(prepared):
    small = [
        {"name": "linear_regression", "kind": "LinearRegression", "params": {}},
        {"name": "ridge_regression", "kind": "Ridge", "params": {"alpha": 1.0}},
        {"name": "forest", "kind": "RandomForest", "params": {"trees": 5, "max_depth": 5, "min_leaf": 5}},
        {"name": "boosted", "kind": "GradientBoosting", "params": {"rounds": 4, "max_depth": 4}},
        {"name": "boosted_fine", "kind": "GradientBoostingFineBins", "params": {"rounds": 4, "max_depth": 4}},
    ]
    return train_all(prepared, small)


def matrix(prepared, split):
    pdf = prepared.part(split).toPandas()
    return pdf[list(prepared.state.features)].to_numpy(float), pdf[config.TARGET].to_numpy(float)


def test_feature_list(prepared):
    assert len(prepared.state.features) == 21
    assert prepared.table.columns == ["ride_id", "split", config.TARGET, *prepared.state.features]


def test_training_rows_are_standardised(prepared):
    x, _ = matrix(prepared, "train")
    np.testing.assert_allclose(x.mean(axis=0), 0, atol=1e-9)
    spread = x.std(axis=0)
    assert np.all((np.abs(spread - 1) < 1e-9) | (spread == 0))


def test_ridge_matches_the_closed_form(prepared):
    x, y = matrix(prepared, "train")
    run = train_model("r", "Ridge", {"alpha": 1.0}, prepared.part("train"), list(prepared.state.features))
    centred = x - x.mean(axis=0)
    expected = np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    np.testing.assert_allclose(run.model.stages[-1].coefficients.toArray(), expected, atol=1e-8)


def test_ols_matches_least_squares(prepared, trained):
    x, y = matrix(prepared, "train")
    design = np.column_stack([np.ones(len(y)), x])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    rmse = np.sqrt(np.mean((y - design @ beta) ** 2))
    row = trained.metrics.where("model_name = 'linear_regression' and split = 'train'").first()
    assert row["rmse"] == pytest.approx(rmse, rel=1e-4)


def test_comparison(trained):
    table = trained.comparison.collect()
    assert len(table) == 5 and trained.comparison.columns == [
        "model_name", "model_class", "train_rmse", "train_r2", "test_rmse", "test_r2", "test_mae", "training_time_s",
    ]
    errors = [r["test_rmse"] for r in table]
    assert errors == sorted(errors) and all(r["training_time_s"] > 0 for r in table)
    assert trained.best().first()["best_model"] == table[0]["model_name"] == trained.best_run().name
    assert all(r["test_r2"] > 0.5 for r in table)


def test_run_log_and_importances(trained):
    log = {(r["model_name"], r["key"]): r["value"] for r in run_log(trained).collect()}
    assert log[("ridge_regression", "alpha")] == "1.0" and ("forest", "test_rmse") in log
    by_name = {r.name: r for r in trained.runs}
    assert sum(importances(by_name["forest"]).values()) == pytest.approx(1.0)
    assert importances(by_name["ridge_regression"]) is None


def test_rows_without_target_are_dropped(spark, rides):
    gaps = rides.withColumn(config.TARGET, F.when(F.col("ride_id") % 10 != 0, F.col(config.TARGET)))
    assert prepare(gaps).table.count() == 900
    exact = prepare(rides, exact=True)
    assert exact.part("test").count() == 200


def test_fit_on_all_rows(rides):
    every = prepare(rides, fit_on="all").state.scaler.means["temperature"]
    assert every == pytest.approx(rides.agg(F.avg("temperature")).first()[0])


def test_missing_values_are_filled_before_features(rides):
    gaps = rides.withColumn("temperature", F.when(F.col("ride_id") % 10 != 0, F.col("temperature")))
    table = prepare(gaps).table
    assert table.where(F.col("temperature").isNull()).count() == 0


def test_state_round_trip(spark, prepared, tmp_path):
    path = str(tmp_path / "state")
    prepared.state.save(spark, path)
    assert FittedState.load(spark, path) == prepared.state


def test_saved_predictor_scores_like_training(spark, rides, prepared, trained, tmp_path):
    path = str(tmp_path / "predictor")
    best = trained.best_run()
    PricePredictor.of(best, prepared.state, {"test_rmse": 0.5}).save(spark, path)
    loaded = PricePredictor.load(spark, path)
    card = loaded.card(spark).first()
    assert card["model_name"] == best.name and len(card["features"]) == 21 and card["metrics"]["test_rmse"] == 0.5
    requests = rides.drop("timestamp", config.TARGET)
    served = {r["ride_id"]: r[RAW] for r in loaded.scorer(requests).collect()}
    direct = predict_with(best, prepared.table).select("ride_id", f"prediction_{best.name}").collect()
    assert len(served) == 1000
    for row in direct:
        assert served[row[0]] == pytest.approx(row[1], abs=1e-9)
    scored, rejected = loaded.predict(raw_requests(rides))
    assert scored.count() + rejected.count() == 1000
    row = scored.first()
    assert 1.0 <= row["price_multiplier"] <= 3.0 and row["confidence"] in ("low", "medium", "high")


def test_outputs(spark, trained, tmp_path):
    files.write_best_metrics(trained.best(), str(tmp_path / "best"))
    row = spark.read.json(str(tmp_path / "best")).first()
    assert set(row.asDict()) == {"best_model", "test_rmse", "test_r2", "test_mae", "training_time"}
    files.write_table(trained.comparison, str(tmp_path / "comparison"), "csv")
    assert len(os_listing(tmp_path / "comparison")) > 0


def os_listing(path):
    return [p for p in path.iterdir() if p.name.endswith(".csv")]


def test_a_saved_pipeline_scores_alone(spark, rides, trained, prepared, tmp_path):
    """Loaded by Spark ML's own reader, it prepares and predicts like the parts it was made of."""
    from pyspark.ml import PipelineModel
    from fareweave.plans.saved_pipeline import state_from_json, state_to_json

    run = next(r for r in trained.runs if r.name == "boosted")
    path = str(tmp_path / "pipeline")
    PricePredictor.of(run, prepared.state, {"test_rmse": 0.1}).save(spark, path)
    loaded = PipelineModel.load(path)
    column = f"prediction_{run.name}"
    got = {r[0]: r[1] for r in loaded.transform(rides).select("_row.ride_id", column).collect()}
    expected = {r["ride_id"]: r[column] for r in predict_with(run, prepared.table).select("ride_id", column).collect()}
    assert got.keys() >= expected.keys() and all(got[k] == pytest.approx(v, abs=1e-12) for k, v in expected.items())
    assert state_from_json(state_to_json(prepared.state)) == prepared.state
    again = PricePredictor.load(spark, path)
    assert (again.name, again.kind, again.metrics, again.state) == (run.name, run.kind, {"test_rmse": 0.1}, prepared.state)


def test_a_pass_of_the_forest_is_small_and_its_size_changes_no_tree(spark, prepared):
    """Every task of an executor holds the histograms of a pass, and what it sends of them."""
    from fareweave.plans.training import LEARNERS

    train, features = prepared.part("train"), list(prepared.state.features)
    assert LEARNERS["RandomForest"]({}, train, config.TARGET).getMaxMemoryInMB() * 4 * 2 <= 1024
    params = {"trees": 4, "max_depth": 6, "min_leaf": 5}
    few, many = (train_model("f", "RandomForest", {**params, **m}, train, features) for m in ({}, {"memory_mb": 0}))
    assert few.model.stages[-1].toDebugString.split("\n")[1:] == many.model.stages[-1].toDebugString.split("\n")[1:]
