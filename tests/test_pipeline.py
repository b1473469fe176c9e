"""The whole pipeline, from rides to predictions and drift history."""

from pyspark.sql import functions as F

from fareweave.plans.pipeline import check_drift, load_predictor, run_pipeline
from fareweave.plans.queries import raw_requests


def test_pipeline(spark, rides, tmp_path):
    out = str(tmp_path / "run")
    experiments = [
        {"name": "linear_regression", "kind": "LinearRegression", "params": {}},
        {"name": "ridge_regression", "kind": "Ridge", "params": {"alpha": 1.0}},
    ]
    trained = run_pipeline(rides, out, experiments, exact_split=True)
    processed = spark.read.parquet(f"{out}/processed")
    assert processed.count() == 1000 and processed.where("split = 'test'").count() == 200
    assert spark.read.parquet(f"{out}/baseline").count() == 800
    comparison = spark.read.option("header", True).csv(f"{out}/model_comparison")
    assert comparison.count() == 2
    assert spark.read.json(f"{out}/metrics").first()["best_model"] == trained.best_run().name
    assert spark.read.parquet(f"{out}/run_log").where("key = 'test_rmse'").count() == 2
    scored, rejected = load_predictor(spark, out).predict(raw_requests(rides))
    assert scored.count() + rejected.count() == 1000
    same = check_drift(spark, rides, out, "2024-02-01 00:00:00").first()
    assert same["reference_rows"] == 800 and same["current_rows"] == 1000 and not same["dataset_drift"]
    colder = rides.withColumn("temperature", F.col("temperature") - 20)
    row = check_drift(spark, colder, out, "2024-02-02 00:00:00").first()
    assert row["drifted_features"] == ["temperature"]
    assert spark.read.parquet(f"{out}/drift_history").count() == 2
