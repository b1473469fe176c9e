"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweave import config
from fareweave.functions import rides as R
from fareweave.functions.numeric import clip, lookup, round_half_even, truncate
from fareweave.operators import drift as D
from fareweave.operators import quality as Q
from fareweave.operators import whatif as X
from fareweave.operators.clean import Imputer, column_modes, drop_columns, fit_imputer, null_counts
from fareweave.operators.counts import in_ranges
from fareweave.operators.encode import (
    OneHotEncoder,
    StandardScaler,
    category_table,
    fit_one_hot,
    fit_scaler,
    scaler_stats,
    severity_from_one_hot,
)
from fareweave.operators.evaluate import best_model, compare_models, evaluate, evaluate_models, metric_log
from fareweave.operators.features import (
    add_features,
    add_interactions,
    add_ratio,
    add_rush_hour,
    add_severity,
    add_time,
)
from fareweave.operators.quantiles import exact_quantiles
from fareweave.operators.score import formula_scorer, score_requests
from fareweave.operators.sketches import merge_sketches, rank_error, sketch_columns, sketch_quantiles
from fareweave.operators.sparse import category_places, sparse_one_hot
from fareweave.operators.split import exact_sample, exact_split, first_rows, hash_split, union_splits
from fareweave.plans import monitoring as M
from fareweave.plans.boosting import NODES, HistogramBoosting, TreeSettings, fit_trees
from fareweave.plans.predictor import PricePredictor
from fareweave.plans.prepare import FittedState, prepare
from fareweave.plans.training import Trained, predict_with, run_log, train_all, train_model, train_table
from fareweave.schema import EVENTS, REQUEST, RIDES, as_text, select_by_class
from fareweave.sources.events import event_columns, load_rides, read_events, stored_hourly
from fareweave.sources.files import (
    append_drift_history,
    document_score,
    label_score,
    parse_requests,
    read_baseline,
    read_drift_history,
    read_rides,
    read_runs,
    read_scenarios,
    read_table,
    to_documents,
    write_best_metrics,
    write_run,
    write_scenarios,
    write_table,
)
from fareweave.storage import materialize, scratch_path
from fareweave.streaming.drift import start_drift
from fareweave.streaming.late import WindowTables, start_windows
from fareweave.streaming.profile import baseline_profile, start_profile, windowed_profile
from fareweave.streaming.scoring import start_scoring

Query = Callable[[SparkSession, str], DataFrame]

# Rides before this moment are the drift baseline, the others the current table.
BASELINE_END = "2024-01-16"
STREAM_WIDTHS = {"temperature": 5.0, "visibility_km": 1.0, "base_fare": 0.5}
STREAM_TEXT = ["weather_condition"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_TEXT = ["l_returnflag", "l_linestatus"]
WHATIF_COLUMNS = [
    "ride_id",
    "passenger_demand",
    "driver_availability",
    "temperature",
    "weather_condition",
    "weather_severity_score",
    "demand_supply_ratio",
    "demand_weather_interaction",
    "fare_per_driver",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(c, 6) + F.lit(0.0)


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def stored_rides(spark: SparkSession, folder: str) -> DataFrame:
    """The ride table written once, as input of the multi-pass preparation."""
    return materialize(load_rides(spark, folder), "rides")


def gappy_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Rides with missing values of every kind at fixed ids."""
    ride = F.col("ride_id")

    def without(c: str, at: int) -> Column:
        return F.when(ride % 7 != at, F.col(c))

    temperature = F.when(ride % 7 == 3, F.lit(float("nan"))).otherwise(F.col("temperature"))
    return load_rides(spark, folder).select(
        "ride_id",
        F.when(ride % 7 != 0, temperature).alias("temperature"),
        without("passenger_demand", 1).alias("passenger_demand"),
        without("weather_condition", 2).alias("weather_condition"),
        "base_fare",
    )


def raw_requests(rides: DataFrame) -> DataFrame:
    """Rides as text requests, some of them invalid at fixed ids."""
    ride = F.col("ride_id")

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    return rides.select(
        "ride_id",
        F.when(ride % 7 == 0, "25").otherwise(text("hour_of_day")).alias("hour_of_day"),
        F.when(ride % 29 == 0, "7").otherwise(text("day_of_week")).alias("day_of_week"),
        F.when(ride % 23 == 0, "maybe").otherwise(text("is_weekend")).alias("is_weekend"),
        F.when(ride % 17 == 0, F.lit(None)).when(ride % 37 == 0, "-3").otherwise(text("passenger_demand")).alias(
            "passenger_demand"
        ),
        F.when(ride % 19 == 0, "18.5").otherwise(text("driver_availability")).alias("driver_availability"),
        F.when(ride % 11 == 0, "hurricane")
        .when(ride % 47 == 0, "clear\n")
        .otherwise(F.col("weather_condition"))
        .alias("weather_condition"),
        F.when(ride % 43 == 0, "warm").otherwise(text("temperature")).alias("temperature"),
        F.when(ride % 31 == 0, "-1").otherwise(text("visibility_km")).alias("visibility_km"),
        F.when(ride % 13 == 0, "-5.0").when(ride % 41 == 0, "NaN").otherwise(text("base_fare")).alias("base_fare"),
    )


def load_requests(spark: SparkSession, folder: str) -> DataFrame:
    return raw_requests(load_rides(spark, folder))


def drift_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the monitored features of the rides before and after ``BASELINE_END``."""
    early = F.col("timestamp") < F.lit(BASELINE_END).cast("timestamp_ntz")
    features = M.encode_weather(add_features(load_rides(spark, folder)))
    return D.count_split(features, early, M.drift_features())


def scored_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Rides with three closed-form predictions and a split."""
    rides = add_features(load_rides(spark, folder))

    def formula(severity: Column) -> Column:
        return R.clip_multiplier(
            R.formula_multiplier(
                F.col("demand_supply_ratio"), severity, F.col("is_rush_hour"), F.col("is_weekend")
            )
        )

    with_predictions = rides.withColumns(
        {
            "p_formula": formula(F.col("weather_severity_score")),
            "p_no_weather": formula(F.lit(0)),
            "p_constant": F.lit(1.5),
        }
    )
    return hash_split(with_predictions, "ride_id", config.TEST_SHARE, config.SEED)


SCORERS = {"formula": "p_formula", "no_weather": "p_no_weather", "constant": "p_constant"}


def scorer_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate_models(scored_rides(spark, folder), config.TARGET, SCORERS)


# --- sources and sinks -------------------------------------------------------


def src_rides(spark, folder):
    return load_rides(spark, folder)


def src_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "rides-csv")
    write_table(load_rides(spark, folder), path, "csv")
    return read_rides(spark, path)


def src_features_roundtrip(spark, folder):
    path = scratch_path(spark, "features")
    features = hash_split(add_features(load_rides(spark, folder)), "ride_id", 0.2, config.SEED)
    columns = ["ride_id", "split", "passenger_demand", "demand_supply_ratio", "is_rush_hour", "is_night"]
    write_table(features.select(*columns), path, partition_by=["split"])
    return read_table(spark, path).select(*columns)


def src_json_requests(spark, folder):
    path = scratch_path(spark, "requests-json")
    requests = load_requests(spark, folder)
    write_table(requests, path, "json")
    schema = as_text(REQUEST).add("ride_id", "long")
    back = read_table(spark, path, schema, "json")
    return back.select("ride_id", "hour_of_day", "passenger_demand", "weather_condition", "is_weekend")


def jsn_requests(spark, folder):
    documents = load_requests(spark, folder).select(
        "ride_id", F.to_json(F.struct(*REQUEST.fieldNames())).alias("body")
    )
    parsed = parse_requests(documents, "body")
    return parsed.select("ride_id", "hour_of_day", "passenger_demand", "weather_condition", "is_weekend")


# --- projection and predicates -----------------------------------------------


def prj_features(spark, folder):
    rides = drop_columns(load_rides(spark, folder), config.ID_COLUMNS)
    features = [c for c in rides.columns if c != config.TARGET]
    return rides.select(*features, F.col(config.TARGET).alias("label"))


def prj_numeric(spark, folder):
    return select_by_class(table(spark, folder, "lineitem"), "numeric")


def prj_categorical(spark, folder):
    return select_by_class(table(spark, folder, "orders"), "categorical")


def flt_masks(spark, folder):
    hour = F.col("hour_of_day")
    return (
        load_rides(spark, folder)
        .where((R.is_rush_hour(hour) == 1) & F.col("is_weekend") & (R.is_night(hour) == 0))
        .select("ride_id", "hour_of_day", "day_of_week")
    )


def flt_valid(spark, folder):
    return Q.split_requests(load_requests(spark, folder))[0]


def flt_quarantine(spark, folder):
    rejected = Q.split_requests(load_requests(spark, folder))[1]
    return rejected.select("ride_id", "hour_of_day", F.concat_ws(",", "errors").alias("errors"))


def _spoilt_documents(spark, folder) -> DataFrame:
    """Requests as JSON documents, by their number cut off, wrapped, doubled, or otherwise spoilt."""
    requests = load_requests(spark, folder)
    body, kind = F.to_json(F.struct(*REQUEST.fieldNames())), F.col("ride_id") % 12
    spoilt = {
        0: F.substring(body, F.lit(1), F.length(body) - 5),
        1: F.concat(F.lit("["), body, F.lit("]")),
        2: F.lit("42"),
        3: F.concat(F.lit('{"hour_of_day": "99", '), F.substring(body, F.lit(2), F.length(body))),
        4: F.concat(body, F.lit(" x")),
        5: F.lit(""),
        6: F.concat(body, F.lit(","), body),
        7: F.concat(body, F.lit("],["), body),
        8: F.lit(None).cast("string"),
        9: F.concat(F.lit("  "), body, F.lit(" \n")),
    }
    text = body
    for k, changed in spoilt.items():
        text = F.when(kind == k, changed).otherwise(text)
    return requests.select("ride_id", text.alias("body"))


def flt_malformed(spark, folder):
    """What is wrong with each rejected document, and how its text begins if it could not be read."""
    rejected = Q.split_requests(parse_requests(_spoilt_documents(spark, folder), "body"))[1]
    return rejected.select(
        "ride_id", F.concat_ws(",", "errors").alias("errors"), F.substring("malformed_document", 1, 1).alias("begins")
    )


def jsn_documents(spark, folder):
    """The fields of the documents that could be read."""
    parsed = parse_requests(_spoilt_documents(spark, folder), "body").where("malformed_document IS NULL")
    return parsed.select("ride_id", "hour_of_day", "passenger_demand", "weather_condition", "is_weekend")


def str_weather_match(spark, folder):
    requests = load_requests(spark, folder)
    return requests.select("ride_id", F.col("weather_condition").rlike(R.WEATHER_PATTERN).alias("matches"))


def str_label_score(spark, folder):
    label = F.concat(
        F.when(F.col("ride_id") % 5 != 0, F.lit("Data drift detected. Drift score: ")).otherwise(
            F.lit("Data drift not available ")
        ),
        F.format_string("%d.%02d", F.col("ride_id") % 3, F.col("passenger_demand") % 100),
    )
    rides = load_rides(spark, folder).select("ride_id", label.alias("label"))
    return rides.select("ride_id", label_score(F.col("label")).alias("score"))


# --- cleaning ------------------------------------------------------------------


def cln_null_profile(spark, folder):
    return null_counts(gappy_rides(spark, folder))


def cln_impute_median(spark, folder):
    rides = gappy_rides(spark, folder).drop("weather_condition")
    filled = fit_imputer(rides, skip=["ride_id"]).transform(rides)
    return rounded(filled, ["temperature", "passenger_demand"])


def cln_impute_mode(spark, folder):
    rides = gappy_rides(spark, folder).select("ride_id", "weather_condition")
    return fit_imputer(rides, skip=["ride_id"]).transform(rides)


def cln_fit_train(spark, folder):
    """Fill values learnt on the training rows and applied to all rows."""
    rides = hash_split(gappy_rides(spark, folder), "ride_id", config.TEST_SHARE, config.SEED)
    train = rides.where(F.col("split") == "train").drop("split")
    filled = fit_imputer(train, skip=["ride_id"]).transform(rides)
    return rounded(filled, ["temperature", "passenger_demand"])


def agg_medians(spark, folder):
    """Exact medians of numeric columns."""
    items = table(spark, folder, "lineitem")
    medians = exact_quantiles(items, LINE_NUMBERS, [0.5])
    return spark.createDataFrame(
        [(c, m[0]) for c, m in medians.items()], "column_name string, median double"
    ).select("column_name", r6("median").alias("median"))


def agg_quantiles_narrow(spark, folder):
    """Exact quantiles with the values in many ranges."""
    items = table(spark, folder, "lineitem")
    shares = [0.01, 0.25, 0.5, 0.9]
    found = exact_quantiles(items, LINE_NUMBERS, shares, parts=60)
    rows = [(c, p, v) for c, values in found.items() for p, v in zip(shares, values)]
    return spark.createDataFrame(rows, "column_name string, share double, value double").select(
        "column_name", "share", r6("value").alias("value")
    )


def agg_modes(spark, folder):
    orders = table(spark, folder, "orders")
    modes = column_modes(orders, ["o_orderstatus", "o_orderpriority"])
    return spark.createDataFrame(list(modes.items()), "column_name string, mode_value string")


# --- encoding, scaling, splitting, sampling -----------------------------------


def enc_categories(spark, folder):
    return category_table(table(spark, folder, "lineitem"), LINE_TEXT)


def enc_onehot(spark, folder):
    rides = load_rides(spark, folder).select("ride_id", "weather_condition")
    return fit_one_hot(rides, ["weather_condition"], 20).transform(rides)


def enc_sparse(spark, folder):
    """Orders with a position for their customer, priority and status, learnt from the orders of odd numbers."""
    columns = ["o_orderpriority", "o_custkey", "o_orderstatus"]
    orders = table(spark, folder, "orders").select("o_orderkey", *columns)
    places = category_places(orders.where("o_orderkey % 2 = 1"), columns)
    coded = sparse_one_hot(orders, columns, places)
    return coded.select("o_orderkey", F.concat_ws(",", F.col("positions").cast("array<string>")).alias("positions"), "size")


def enc_onehot_unknown(spark, folder):
    """Categories of the open orders applied to all orders."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    known = orders.where(F.col("o_orderpriority") != "5-LOW")
    encoded = fit_one_hot(known, ["o_orderpriority"], 20).transform(orders)
    return encoded.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in encoded.columns])


def enc_severity_from_onehot(spark, folder):
    rides = load_rides(spark, folder).select("ride_id", "weather_condition")
    encoded = fit_one_hot(rides, ["weather_condition"], 20).transform(rides)
    return severity_from_one_hot(severity_from_one_hot(encoded)).select("ride_id", "weather_severity_score")


def scl_fit(spark, folder):
    stats = scaler_stats(table(spark, folder, "lineitem"), LINE_NUMBERS)
    return rounded(stats, ["mean", "std"])


def scl_transform(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return rounded(fit_scaler(items, LINE_NUMBERS).transform(items), LINE_NUMBERS)


def scl_train_only(spark, folder):
    columns = ["temperature", "visibility_km", "base_fare"]
    rides = hash_split(load_rides(spark, folder), "ride_id", config.TEST_SHARE, config.SEED)
    rides = rides.select("ride_id", "split", *columns)
    scaler = fit_scaler(rides.where(F.col("split") == "train"), columns)
    return rounded(scaler.transform(rides), columns)


def spl_hash(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return hash_split(orders, "o_orderkey", config.TEST_SHARE, config.SEED)


def spl_exact(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return exact_split(orders, "o_orderkey", config.TEST_SHARE, config.SEED)


def smp_exact(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return exact_sample(orders, "o_orderkey", 1000, config.SEED)


def spl_exact_dup(spark, folder):
    """Sizes of an exact split by a key that rows share."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    split = exact_split(items, "l_orderkey", config.TEST_SHARE, config.SEED)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("_q")).select("split", "n")


def smp_exact_null(spark, folder):
    """The size of an exact sample of rows whose keys are mostly missing."""
    items = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, F.col("l_orderkey")).alias("k"), "l_quantity"
    )
    sample = exact_sample(items, "k", 5000, config.SEED)
    return sample.agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("with_key"))


def smp_head(spark, folder):
    return first_rows(load_rides(spark, folder), "ride_id", 5)


def set_union_splits(spark, folder):
    rides = hash_split(load_rides(spark, folder), "ride_id", config.TEST_SHARE, config.SEED)
    rides = rides.select("ride_id", "base_fare", "split")
    return union_splits(rides.where(F.col("split") == "train"), rides.where(F.col("split") == "test"))


# --- features ------------------------------------------------------------------


def feat_ratio(spark, folder):
    return add_ratio(load_rides(spark, folder)).select("ride_id", "demand_supply_ratio")


def feat_rush(spark, folder):
    return add_rush_hour(load_rides(spark, folder)).select("ride_id", "is_rush_hour")


def feat_severity(spark, folder):
    rides = gappy_rides(spark, folder)
    return add_severity(rides).select("ride_id", "weather_severity_score")


def feat_cyclical(spark, folder):
    rides = add_time(load_rides(spark, folder))
    return rounded(rides, ["hour_sin", "hour_cos"]).select("ride_id", "hour_sin", "hour_cos")


def feat_night(spark, folder):
    return add_time(load_rides(spark, folder)).select("ride_id", "is_night")


def feat_interactions(spark, folder):
    rides = add_interactions(add_severity(load_rides(spark, folder)))
    return rides.select("ride_id", "demand_weather_interaction", "fare_per_driver")


def feat_calendar(spark, folder):
    day = F.col("o_orderdate")
    weekday = F.weekday(day)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.hour(day).alias("hour_of_day"),
        weekday.alias("day_of_week"),
        F.month(day).alias("month"),
        R.is_weekend(weekday).alias("is_weekend"),
    )


def feat_clip_round_cast(spark, folder):
    price, account = F.col("o_totalprice"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        clip(account / 1000.0, 20.0, 150.0).alias("clipped"),
        clip(account / 1000.0, low=100.0).alias("clipped_low"),
        round_half_even(price / 7.0, 2).alias("rounded"),
        truncate(price / 7.0 - 10000.0, "bigint").alias("truncated"),
    )


def feat_lookup(spark, folder):
    ranks = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return table(spark, folder, "orders").select(
        "o_orderkey", lookup(F.col("o_orderpriority"), ranks, 9).alias("priority_rank")
    )


def feat_all(spark, folder):
    return rounded(add_features(load_rides(spark, folder)), ["hour_sin", "hour_cos"])


def feat_prepared(spark, folder):
    """The model-ready table: split, target and scaled features."""
    prepared = prepare(stored_rides(spark, folder))
    return rounded(prepared.table, list(prepared.state.features))


def fml_price(spark, folder):
    rides = add_features(load_rides(spark, folder))
    formula = R.formula_multiplier(
        F.col("demand_supply_ratio"),
        F.col("weather_severity_score"),
        F.col("is_rush_hour"),
        F.col("is_weekend"),
    )
    return rides.select("ride_id", R.clip_multiplier(formula).alias("multiplier"))


def fml_fare(spark, folder):
    rides = load_rides(spark, folder)
    fare = R.clip_fare(R.cyclic_fare(F.col("hour_of_day")))
    return rides.select("ride_id", r6(fare).alias("cyclic_fare"))


# --- aggregates ----------------------------------------------------------------


def agg_describe(spark, folder):
    return Q.describe(table(spark, folder, "lineitem"), LINE_NUMBERS)


def agg_describe_target(spark, folder):
    return Q.describe(load_rides(spark, folder), [config.TARGET])


def agg_std(spark, folder):
    return rounded(Q.sample_std(table(spark, folder, "lineitem"), LINE_NUMBERS), ["std"])


def agg_dq_rules(spark, folder):
    rides = load_rides(spark, folder)
    return Q.check_rules(rides, [*Q.ride_rules(rides), Q.weekend_rule()])


def agg_domain(spark, folder):
    requests = load_requests(spark, folder)
    return Q.domain_report(requests, "weather_condition", list(R.WEATHER_SEVERITY))


def agg_outside_domain(spark, folder):
    return Q.values_outside(table(spark, folder, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


# --- evaluation ------------------------------------------------------------------


def eva_metrics(spark, folder):
    metrics = evaluate(scored_rides(spark, folder), config.TARGET, "p_formula")
    return rounded(metrics, ["rmse", "mae", "r2"])


def eva_splits(spark, folder):
    return rounded(scorer_metrics(spark, folder), ["rmse", "mae", "r2"])


def eva_compare(spark, folder):
    table_ = compare_models(scorer_metrics(spark, folder))
    return rounded(table_, [c for c in table_.columns if c != "model_name"])


def eva_best(spark, folder):
    best = best_model(compare_models(scorer_metrics(spark, folder)))
    return rounded(best.drop("training_time"), ["test_rmse", "test_r2", "test_mae"])


def eva_run_log(spark, folder):
    return rounded(metric_log(scorer_metrics(spark, folder)), ["value"])


# --- scoring ---------------------------------------------------------------------


def sco_batch(spark, folder):
    scored, _ = score_requests(load_requests(spark, folder), formula_scorer)
    return scored.select("ride_id", "price_multiplier", "estimated_price", "confidence")


def sco_confidence(spark, folder):
    prices = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 20.0 + 0.8).alias("p")
    )
    return prices.withColumn("confidence", R.confidence(R.clip_multiplier(F.col("p"))))


def sco_state(spark, folder):
    """Fitted state after saving and loading."""
    state = prepare(stored_rides(spark, folder)).state
    path = scratch_path(spark, "state")
    state.save(spark, path)
    back = FittedState.load(spark, path).to_table(spark)
    scale = back.where(F.col("kind") == "scale")
    return scale.select("column_name", r6("number").alias("mean"), r6("number2").alias("std"))


# --- drift -----------------------------------------------------------------------


def drf_route(spark, folder):
    """The tests of both routes."""
    counts = drift_counts(spark, folder)
    large = D.route_tests(counts, D.DriftOptions(route="large"))
    small = D.route_tests(counts, D.DriftOptions(route="small")).select("feature", F.col("test").alias("small_test"))
    routed = large.join(small, "feature")
    return routed.select("feature", "ref_rows", "cur_rows", "distinct_values", "test", "small_test")


def _ordered(spark, folder, parts: int | None = None) -> DataFrame:
    counts = drift_counts(spark, folder)
    tests = D.route_tests(counts, D.DriftOptions(route="large")).where(F.col("test") == "wasserstein")
    values = counts.where(F.col("x").isNotNull() & (F.col("feature") != D.ROWS))
    return D.ordered_statistics(in_ranges(values, parts=parts), tests)


def drf_wasserstein(spark, folder):
    return _ordered(spark, folder).select("feature", r6("wasserstein").alias("score"))


def drf_wasserstein_bucketed(spark, folder):
    """The same distance with the values of every feature in many ranges."""
    return _ordered(spark, folder, 200).select("feature", r6("wasserstein").alias("score"))


def drf_ks(spark, folder):
    return _ordered(spark, folder, 20).select("feature", r6("ks").alias("ks"))


def _categories(spark, folder) -> DataFrame:
    counts = drift_counts(spark, folder)
    tests = D.route_tests(counts, D.DriftOptions(route="large"))
    return D.category_statistics(counts, tests.where(F.col("test") == "jensen_shannon"))


def drf_js(spark, folder):
    return _categories(spark, folder).select("feature", r6("jensen_shannon").alias("score"))


def drf_category_tests(spark, folder):
    """Chi-square and z statistics of the low-cardinality columns."""
    return _categories(spark, folder).select("feature", r6("chi_square").alias("chi_square"), r6("z").alias("z"))


def _report(spark, folder, options: D.DriftOptions = D.DriftOptions()) -> DataFrame:
    return D.score_counts(drift_counts(spark, folder), M.drift_features(), options)


def drf_report(spark, folder):
    return rounded(_report(spark, folder), ["statistic", "score"])


def drf_small(spark, folder):
    """The report with the tests of a small baseline."""
    report = _report(spark, folder, D.DriftOptions(route="small"))
    return report.select("feature", "test", r6("statistic").alias("statistic"))


def drf_small_p(spark, folder):
    return rounded(_report(spark, folder, D.DriftOptions(route="small")), ["statistic", "score"])


def _flat_summary(summary: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return summary.select(
        *(keys or []),
        "reference_rows",
        "current_rows",
        "dataset_drift",
        "n_drifted_features",
        F.concat_ws(",", "drifted_features").alias("drifted_features"),
    )


def drf_summary(spark, folder):
    return _flat_summary(D.summarize(_report(spark, folder)))


def drf_policies(spark, folder):
    """The verdict under each rule for the whole table."""
    totals = _report(spark, folder).agg(
        F.count_if("drift_detected").alias("n_drifted_features"), F.count(F.lit(1)).alias("_n")
    )
    verdicts = [
        F.struct(
            F.lit(policy).alias("policy"),
            D.dataset_rule(D.DriftOptions(policy=policy, min_features=3, min_share=0.5)).alias("dataset_drift"),
        )
        for policy in ["any", "min_features", "share"]
    ]
    listed = totals.select("n_drifted_features", F.explode(F.array(*verdicts)).alias("_v"))
    return listed.select("_v.policy", "n_drifted_features", "_v.dataset_drift")


def drf_document(spark, folder):
    """Scores read back from the JSON document of a run."""
    stamped = D.stamp(D.summarize(_report(spark, folder)), "2024-02-01 00:00:00")
    documents = materialize(to_documents(stamped), "documents")
    out = None
    for feature in ["temperature", "passenger_demand", "no_such_column"]:
        found, score = document_score(F.col("document"), feature)
        row = documents.select(
            F.lit(feature).alias("feature"), found.alias("drift_detected"), r6(score).alias("score")
        )
        out = row if out is None else out.unionByName(row)
    return out


def drf_sample(spark, folder):
    """A perturbed exact sample against the rides it comes from."""
    samples = {"demand_mild": (2000, config.SEED)}
    report = M.compare_scenarios(
        load_rides(spark, folder), [X.DEMAND_SPIKES["mild"]], D.DriftOptions(route="large"), samples
    )
    return report.select("feature", "test", r6("score").alias("score"), "current_rows", "drift_detected")


def drf_lineitem(spark, folder):
    """Drift of numeric and text columns of another table."""
    items = table(spark, folder, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    columns = [*LINE_NUMBERS, *LINE_TEXT]
    # Rows without a ship date belong to neither part; one scan counts both.
    report = D.score_counts(D.count_split(items, early, columns), columns)
    return rounded(report, ["statistic", "score"])


# --- results written and read back ---------------------------------------------------


def src_baseline(spark, folder):
    """The monitoring baseline of the training rows."""
    rides = hash_split(load_rides(spark, folder), "ride_id", config.TEST_SHARE, config.SEED)
    path = scratch_path(spark, "baseline")
    write_table(add_features(rides.where("split = 'train'")), path)
    names = ["ride_id", "passenger_demand", "demand_supply_ratio", "is_rush_hour", "is_night"]
    return read_baseline(spark, path).select(*names)


def snk_comparison(spark, folder):
    path = scratch_path(spark, "comparison")
    table_ = compare_models(scorer_metrics(spark, folder))
    write_table(table_, path, "csv")
    back = read_table(spark, path, table_.schema, "csv")
    return rounded(back, [c for c in back.columns if c != "model_name"])


def snk_best(spark, folder):
    path = scratch_path(spark, "best")
    write_best_metrics(best_model(compare_models(scorer_metrics(spark, folder))), path)
    schema = "best_model string, test_rmse double, test_r2 double, test_mae double"
    return rounded(spark.read.schema(schema).json(path), ["test_rmse", "test_r2", "test_mae"])


def snk_drift_history(spark, folder):
    """Two runs of two days in one history."""
    path = scratch_path(spark, "history")
    summary = D.summarize(_report(spark, folder))
    for run_time in ("2024-02-01 10:00:00", "2024-02-02 10:00:00"):
        append_drift_history(D.stamp(summary, run_time), path)
    history = read_drift_history(spark, path)
    return _flat_summary(history.withColumn("run_date", F.col("run_date").cast("string")), ["run_date"])


def snk_drift_rerun(spark, folder):
    """A run that is repeated under its id, and one under another id, in one history."""
    path = scratch_path(spark, "history")
    summary = materialize(D.stamp(D.summarize(_report(spark, folder)), "2024-02-01 10:00:00"), "drift-summary")
    for run_id in ("007", "007", "b"):
        append_drift_history(summary, path, run_id)
    return _flat_summary(read_drift_history(spark, path), ["run"])


def snk_runs(spark, folder):
    """The logs of two runs, one of them written twice."""
    path = scratch_path(spark, "run-log")
    log = materialize(run_log(_one_feature(spark, folder, "demand_supply_ratio", ONE_LINEAR)), "log")
    write_run(log.where("model_name = 'ridge_regression'"), path, "1")
    for run_id in ("1", "2024-02-02"):
        write_run(log, path, run_id)
    kept = read_runs(spark, path).where("key <> 'training_time'")
    number = F.when(F.col("kind") == "metric", r6(F.col("value").cast("double")))
    text = F.when(F.col("kind") == "param", F.col("value"))
    return kept.select("run", "model_name", "kind", "key", number.alias("number"), text.alias("text"))


def snk_scenarios(spark, folder):
    """The combined results of a simulation."""
    path = scratch_path(spark, "scenarios")
    write_scenarios(M.run_simulation(load_rides(spark, folder), options=D.DriftOptions(route="large")), path)
    return _flat_summary(read_scenarios(spark, path), ["scenario"])


# --- what-if -----------------------------------------------------------------------


def _whatif(scenario: X.Scenario) -> Query:
    def run(spark, folder):
        return X.apply_scenario(load_rides(spark, folder), scenario).select(*WHATIF_COLUMNS)

    return run


def wif_compare(spark, folder):
    report = M.compare_scenarios(load_rides(spark, folder), options=D.DriftOptions(route="large"))
    return report.select("scenario", "feature", "test", r6("score").alias("score"), "drift_detected")


def wif_summary(spark, folder):
    summary = M.run_simulation(load_rides(spark, folder), options=D.DriftOptions(route="large"))
    return _flat_summary(summary, ["scenario"])


def wif_errors(spark, folder):
    """A scenario that cannot be applied gets an error row; the others are reported."""
    scenarios = ["mild", "catastrophic", X.Scenario("hail", weather="hail"), X.CONTROL]
    summary = M.run_simulation(load_rides(spark, folder), scenarios, D.DriftOptions(route="large"))
    return summary.select("scenario", "n_drifted_features", F.col("error").isNotNull().alias("failed"))


def wif_isolated(spark, folder):
    """A scenario whose rows cannot be computed gets an error row; those before and after it are reported."""
    scenarios = [
        "severe",
        X.Scenario("broken", changes=(("base_fare", "base_fare / (day_of_week - day_of_week)"),)),
        X.Scenario("fares_up", changes=(("base_fare", "base_fare * 1.5D"),)),
        X.CONTROL,
    ]
    summary = M.run_simulation(load_rides(spark, folder), scenarios, D.DriftOptions(route="large"))
    why = F.regexp_extract("error", r"\[([A-Z_]+)\]", 1)
    return summary.select(
        "scenario", "n_drifted_features", F.concat_ws(",", "drifted_features").alias("drifted_features"), why.alias("why")
    )


# --- training ----------------------------------------------------------------------


def _experiment(name: str) -> list[dict]:
    return [e for e in config.EXPERIMENTS if e["name"] == name]


def _trained(spark, folder, names: list[str]) -> Trained:
    experiments = [e for n in names for e in _experiment(n)]
    return train_all(prepare(stored_rides(spark, folder)), experiments)


def _training(name: str) -> Query:
    def run(spark, folder):
        return _trained(spark, folder, [name]).comparison

    return run


def trn_compare(spark, folder):
    return _trained(spark, folder, ["linear_regression", "ridge_regression"]).comparison


def trn_run_log(spark, folder):
    return run_log(_trained(spark, folder, ["linear_regression", "ridge_regression"]))


def _predictor(spark, folder) -> PricePredictor:
    prepared = prepare(stored_rides(spark, folder))
    trained = train_all(prepared, _experiment("linear_regression") + _experiment("ridge_regression"))
    record = trained.best().first().asDict()
    metrics = {k: v for k, v in record.items() if k != "best_model"}
    path = scratch_path(spark, "predictor")
    PricePredictor.of(trained.best_run(), prepared.state, metrics).save(spark, path)
    return PricePredictor.load(spark, path)


# With one feature, every learner has a closed form.
ONE_LINEAR = [
    {"name": "linear_regression", "kind": "LinearRegression", "params": {}},
    {"name": "ridge_regression", "kind": "Ridge", "params": {"alpha": 50.0}},
]
ONE_TREE = {
    "RandomForest": {"trees": 1, "max_depth": 1, "bootstrap": False},
    "GradientBoosting": {"rounds": 1, "max_depth": 1, "row_share": 1.0, "column_share": 1.0},
    "GradientBoostingFineBins": {"rounds": 1, "max_depth": 1, "row_share": 1.0, "column_share": 1.0},
}


def _one_feature(spark, folder, feature: str, experiments: list[dict]) -> Trained:
    """Learners on one unscaled feature of the rides."""
    rides = hash_split(add_features(load_rides(spark, folder)), "ride_id", config.TEST_SHARE, config.SEED)
    columns = ["ride_id", "split", config.TARGET, F.col(feature).cast("double").alias(feature)]
    return train_table(materialize(rides.select(*columns), "one-feature"), [feature], experiments)


def _one_metrics(trained: Trained) -> DataFrame:
    return rounded(trained.metrics, ["rmse", "mae", "r2"])


def _one_linear(name: str) -> Query:
    def run(spark, folder):
        chosen = [e for e in ONE_LINEAR if e["name"] == name]
        return _one_metrics(_one_feature(spark, folder, "demand_supply_ratio", chosen))

    return run


def _one_tree(kind: str) -> Query:
    def run(spark, folder):
        experiment = {"name": kind, "kind": kind, "params": ONE_TREE[kind]}
        return _one_metrics(_one_feature(spark, folder, "is_weekend", [experiment]))

    return run


def trn_compare_one(spark, folder):
    """The comparison of both linear learners, without times."""
    trained = _one_feature(spark, folder, "demand_supply_ratio", ONE_LINEAR)
    table_ = trained.comparison.drop("training_time_s")
    return rounded(table_, [c for c in table_.columns if c.startswith(("train_", "test_"))])


def trn_run_log_one(spark, folder):
    """The log of both linear learners, without times."""
    log = run_log(_one_feature(spark, folder, "demand_supply_ratio", ONE_LINEAR)).where("key <> 'training_time'")
    number = F.when(F.col("kind") == "metric", r6(F.col("value").cast("double")))
    text = F.when(F.col("kind") == "param", F.col("value"))
    return log.select("model_name", "kind", "key", number.alias("number"), text.alias("text"))


def _one_predictor(spark, folder) -> PricePredictor:
    """The better linear learner, saved and read back."""
    trained = _one_feature(spark, folder, "demand_supply_ratio", ONE_LINEAR)
    state = FittedState(Imputer(), OneHotEncoder({}), StandardScaler({}, {}), ("demand_supply_ratio",))
    record = trained.best().first().asDict()
    metrics = {k: v for k, v in record.items() if k not in ("best_model", "training_time")}
    path = scratch_path(spark, "predictor")
    PricePredictor.of(trained.best_run(), state, metrics).save(spark, path)
    return PricePredictor.load(spark, path)


def sco_model_one(spark, folder):
    scored, _ = _one_predictor(spark, folder).predict(load_requests(spark, folder))
    return scored.select("ride_id", "price_multiplier", "estimated_price", "confidence")


def sco_pipeline_one(spark, folder):
    """The saved pipeline alone, read back: raw predictions of the valid requests."""
    trained = _one_feature(spark, folder, "demand_supply_ratio", ONE_LINEAR)
    state = FittedState(Imputer(), OneHotEncoder({}), StandardScaler({}, {}), ("demand_supply_ratio",))
    best = trained.best_run()
    path = scratch_path(spark, "pipeline")
    PricePredictor.of(best, state).save(spark, path)
    accepted = Q.split_requests(load_requests(spark, folder))[0]
    scored = PipelineModel.load(path).transform(accepted)
    return scored.select("_row.ride_id", r6(F.col(f"prediction_{best.name}")).alias("prediction"))


def _gradient(name: str) -> Query:
    """How the loss of a fitted linear model changes with each of its weights: not at all, where it was found."""

    def run(spark, folder):
        prepared = prepare(stored_rides(spark, folder))
        table_ = materialize(prepared.table, "prepared", evenly=True)
        features, experiment = list(prepared.state.features), _experiment(name)[0]
        train = table_.where("split = 'train'")
        fitted = train_model(name, experiment["kind"], experiment["params"], train, features)
        weights = dict(zip(features, fitted.model.stages[-1].coefficients.toArray().tolist()))
        off = F.col(config.TARGET) - F.col(f"prediction_{name}")
        alpha = experiment["params"].get("alpha", 0.0)
        scored = predict_with(fitted, train)
        slopes = [
            (F.avg(off * F.col(c)) - F.lit(alpha * weights[c]) / F.count(F.lit(1))).alias(c) for c in features
        ]
        return rounded(
            scored.agg(*slopes, F.avg(off).alias("intercept")).unpivot([], [*features, "intercept"], "weight", "gradient"),
            ["gradient"],
        )

    return run


def sco_model_card_one(spark, folder):
    card = _one_predictor(spark, folder).card(spark)
    metrics = [r6(F.col("metrics")[m]).alias(m) for m in ("test_rmse", "test_r2", "test_mae")]
    return card.select("model_name", "model_type", F.concat_ws(",", "features").alias("features"), *metrics)


trn_ols_one = _one_linear("linear_regression")
trn_ridge_one = _one_linear("ridge_regression")
trn_forest_one = _one_tree("RandomForest")
trn_gbt_one = _one_tree("GradientBoosting")
trn_gbt_alt_one = _one_tree("GradientBoostingFineBins")


# A few trees on several unscaled features: small enough for SQL to grow them leaf by leaf.
FEW_FEATURES = [
    "hour_of_day", "day_of_week", "passenger_demand", "driver_availability", "weather_severity_score", "base_fare",
]
FEW_TREES = {
    "leafwise": TreeSettings(rounds=3, learning_rate=0.3, leaves=4, max_depth=3, min_leaf=20, l2=0.0, bins=16),
    "levelwise": TreeSettings(rounds=3, learning_rate=0.3, leaves=None, max_depth=2, min_leaf=1, l2=1.0, bins=16),
}


def _few_rows(spark, folder) -> DataFrame:
    rides = hash_split(add_features(stored_rides(spark, folder)), "ride_id", config.TEST_SHARE, config.SEED)
    return rides.select("ride_id", "split", config.TARGET, *[F.col(c).cast("double").alias(c) for c in FEW_FEATURES])


def _few_trees(kind: str) -> Query:
    """The nodes of all trees."""

    def run(spark, folder):
        train = _few_rows(spark, folder).where("split = 'train'")
        forest = fit_trees(train, FEW_FEATURES, config.TARGET, FEW_TREES[kind])
        nodes = spark.createDataFrame(forest.rows(), NODES)
        names = F.get(F.array(*[F.lit(c) for c in FEW_FEATURES]), F.col("feature"))
        return rounded(nodes.withColumn("feature", names), ["threshold", "gain", "value"])

    return run


def _few_predictions(kind: str) -> Query:
    """What the trees, saved and read back as a model, predict for each ride."""

    def run(spark, folder):
        table_ = _few_rows(spark, folder)
        settings = FEW_TREES[kind]
        learner = HistogramBoosting(settings=settings).setFeaturesCol("v").setLabelCol(config.TARGET).setPredictionCol("p")
        assembler = VectorAssembler(inputCols=FEW_FEATURES, outputCol="v")
        path = scratch_path(spark, "few-trees")
        Pipeline(stages=[assembler, learner]).fit(table_.where("split = 'train'")).save(path)
        scored = PipelineModel.load(path).transform(table_)
        return scored.select("ride_id", "split", r6(F.col("p")).alias("prediction"))

    return run


def sco_model_card(spark, folder):
    return _predictor(spark, folder).card(spark)


def sco_model(spark, folder):
    scored, _ = _predictor(spark, folder).predict(load_requests(spark, folder))
    return scored.select("ride_id", "price_multiplier", "estimated_price", "confidence")


# --- streaming ---------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
    return reader.parquet(folder)


def _ride_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Ride columns of an event stream, with demand and supply from the stored hours."""
    hourly = stored_hourly(read_events(spark, folder))
    columns = [c.alias(n) for n, c in event_columns().items()]
    base = _event_stream(spark, folder).select(F.date_trunc("hour", "ts").alias("_hour"), *columns)
    return base.join(hourly, "_hour", "left")


def stm_score(spark, folder):
    scored = scratch_path(spark, "stream-scored")
    requests = raw_requests(_ride_stream(spark, folder))
    query = start_scoring(
        requests,
        formula_scorer,
        scored,
        scratch_path(spark, "stream-rejected"),
        scratch_path(spark, "stream-checkpoint"),
    )
    query.awaitTermination()
    return spark.read.parquet(scored).select("ride_id", "price_multiplier", "estimated_price", "confidence")


def stm_quarantine(spark, folder):
    rejected = scratch_path(spark, "stream-rejected")
    query = start_scoring(
        raw_requests(_ride_stream(spark, folder)),
        formula_scorer,
        scratch_path(spark, "stream-scored"),
        rejected,
        scratch_path(spark, "stream-checkpoint"),
    )
    query.awaitTermination()
    return spark.read.parquet(rejected).select("ride_id", F.concat_ws(",", "errors").alias("errors"))


def _window_stream(spark: SparkSession, folder: str) -> DataFrame:
    columns = event_columns()
    needed = ["timestamp", *STREAM_WIDTHS, *STREAM_TEXT]
    base = _event_stream(spark, folder).select(*[columns[c].alias(c) for c in needed])
    return windowed_profile(base, "timestamp", STREAM_WIDTHS, STREAM_TEXT)


def stm_profile(spark, folder):
    path = scratch_path(spark, "stream-profile")
    query = start_profile(_window_stream(spark, folder), path, scratch_path(spark, "stream-checkpoint"))
    query.awaitTermination()
    counts = spark.read.parquet(path)
    return counts.where(F.col("feature") != D.ROWS).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "feature", "x", "v", "n"
    )


def stm_drift(spark, folder):
    columns = [*STREAM_WIDTHS, *STREAM_TEXT]
    parts = event_columns()
    early = F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz")
    rides = read_events(spark, folder).where(early).select(*[parts[c].alias(c) for c in columns])
    path = scratch_path(spark, "stream-drift")
    query = start_drift(
        _window_stream(spark, folder),
        baseline_profile(rides, STREAM_WIDTHS, STREAM_TEXT),
        columns,
        path,
        scratch_path(spark, "stream-checkpoint"),
        D.DriftOptions(route="large"),
    )
    query.awaitTermination()
    scores = spark.read.parquet(path)
    return scores.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "feature",
        "test",
        r6("score").alias("score"),
        "drift_detected",
    )


ARRIVALS = 4


def _late_tables(spark: SparkSession, folder: str) -> WindowTables:
    """All events, arriving in four lots by their number: each lot holds times of the whole month."""
    columns = event_columns()
    needed = ["ride_id", "timestamp", *STREAM_WIDTHS, *STREAM_TEXT]
    rides = read_events(spark, folder).select(*[columns[c].alias(c) for c in needed])
    source, out, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("arrived", "windows", "windows-checkpoint"))
    for lot in range(ARRIVALS):
        rides.where(F.col("ride_id") % ARRIVALS == lot).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rides.schema).parquet(source)
        start_windows(stream, "timestamp", STREAM_WIDTHS, STREAM_TEXT, out, checkpoint).awaitTermination()
    return WindowTables(spark, out)


def _utc(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


def stm_late(spark, folder):
    """The rows that came after their window was closed."""
    return _late_tables(spark, folder).late().select("ride_id", _utc("window_start"), "reason")


def stm_windows(spark, folder):
    """The counts of all windows, closed or open."""
    tables = _late_tables(spark, folder)
    both = tables.closed().withColumn("closed", F.lit(True)).unionByName(tables.open().withColumn("closed", F.lit(False)))
    return both.select(_utc("window_start"), "feature", "x", "v", "n", "closed")


def stm_balance(spark, folder):
    """After each batch: rows of the stream, in windows, late, without a time."""
    return _late_tables(spark, folder).progress().select(
        "batch_id", _utc("watermark"), "rows_in", "rows_kept", "rows_late", "rows_untimed"
    )


SKETCHED = ["l_quantity", "l_extendedprice", "l_discount"]
SHARES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


def agg_sketches(spark, folder):
    """Quantiles from sketches of (flag, status) parts, stored and merged: are their exact ranks within the bound?"""
    lines = table(spark, folder, "lineitem")
    parts = materialize(sketch_columns(lines, SKETCHED, ["l_returnflag", "l_linestatus"]), "sketches")
    merged = materialize(sketch_quantiles(merge_sketches(parts), SHARES), "quantiles")
    asked = merged.select("feature", "n", F.posexplode("quantiles").alias("i", "q"))
    # Rows below, and up to, each estimate.
    long = lines.select(*[F.col(c).cast("double").alias(c) for c in SKETCHED]).unpivot([], SKETCHED, "feature", "x")
    ranked = long.join(F.broadcast(asked), "feature").groupBy("feature", "n", "i").agg(
        F.count_if(F.col("x") < F.col("q")).alias("below"), F.count_if(F.col("x") <= F.col("q")).alias("upto")
    )
    share, slack = F.element_at(F.array(*[F.lit(p) for p in SHARES]), F.col("i") + 1), 2 * rank_error() * F.col("n")
    inside = (F.col("below") <= share * F.col("n") + slack) & (F.col("upto") >= share * F.col("n") - slack)
    return ranked.select("feature", share.alias("p"), "n", inside.alias("within"))


def drf_ks_exact(spark, folder):
    """Exact p-values: events, users and mean values per two hours, the first half of the day against the second."""
    slots = (
        read_events(spark, folder).where("ts IS NOT NULL")
        .groupBy(F.floor(F.hour("ts") / 2).alias("slot"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("events"), F.countDistinct("user_id").cast("double").alias("users"),
            F.round(F.avg("value"), 0).alias("mean_value"), F.pmod(F.count(F.lit(1)), F.lit(7)).cast("double").alias("odd"),
        )
    )
    slots = materialize(slots, "slots")
    options = D.DriftOptions(route="small", exact_ks=True, few_values=0)
    report = D.drift_report(
        slots.where("slot < 6"), slots.where("slot >= 6"), ["events", "users", "mean_value", "odd"], options
    )
    return rounded(report.select("feature", "test", "statistic", "score", "drift_detected"), ["statistic", "score"])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        src_rides,
        src_csv_roundtrip,
        src_features_roundtrip,
        src_json_requests,
        jsn_requests,
        prj_features,
        prj_numeric,
        prj_categorical,
        flt_masks,
        flt_valid,
        flt_quarantine,
        flt_malformed,
        jsn_documents,
        str_weather_match,
        str_label_score,
        cln_null_profile,
        cln_impute_median,
        cln_impute_mode,
        cln_fit_train,
        agg_medians,
        agg_modes,
        agg_quantiles_narrow,
        agg_sketches,
        enc_categories,
        enc_onehot,
        enc_onehot_unknown,
        enc_sparse,
        enc_severity_from_onehot,
        scl_fit,
        scl_transform,
        scl_train_only,
        spl_hash,
        spl_exact,
        smp_exact,
        smp_head,
        spl_exact_dup,
        smp_exact_null,
        set_union_splits,
        feat_ratio,
        feat_rush,
        feat_severity,
        feat_cyclical,
        feat_night,
        feat_interactions,
        feat_calendar,
        feat_clip_round_cast,
        feat_lookup,
        feat_all,
        feat_prepared,
        fml_price,
        fml_fare,
        agg_describe,
        agg_describe_target,
        agg_std,
        agg_dq_rules,
        agg_domain,
        agg_outside_domain,
        eva_metrics,
        eva_splits,
        eva_compare,
        eva_best,
        eva_run_log,
        sco_batch,
        sco_confidence,
        sco_state,
        drf_route,
        drf_wasserstein,
        drf_wasserstein_bucketed,
        drf_ks,
        drf_js,
        drf_category_tests,
        drf_report,
        drf_small,
        drf_small_p,
        drf_ks_exact,
        drf_summary,
        drf_policies,
        drf_document,
        drf_sample,
        drf_lineitem,
        src_baseline,
        snk_comparison,
        snk_best,
        snk_drift_history,
        snk_drift_rerun,
        snk_runs,
        snk_scenarios,
        wif_compare,
        wif_summary,
        wif_errors,
        wif_isolated,
        trn_compare,
        trn_run_log,
        sco_model_card,
        sco_model,
        stm_score,
        stm_quarantine,
        stm_profile,
        stm_drift,
        stm_late,
        stm_windows,
        stm_balance,
    ]
}
QUERIES |= {
    "wif_demand_mild": _whatif(X.DEMAND_SPIKES["mild"]),
    "wif_demand_moderate": _whatif(X.DEMAND_SPIKES["moderate"]),
    "wif_demand_severe": _whatif(X.DEMAND_SPIKES["severe"]),
    "wif_weather": _whatif(X.WEATHER_SHIFT),
    "trn_ols_one": trn_ols_one,
    "trn_ridge_one": trn_ridge_one,
    "trn_forest_one": trn_forest_one,
    "trn_gbt_one": trn_gbt_one,
    "trn_gbt_alt_one": trn_gbt_alt_one,
    "trn_compare_one": trn_compare_one,
    "trn_run_log_one": trn_run_log_one,
    "sco_model_one": sco_model_one,
    "sco_model_card_one": sco_model_card_one,
    "sco_pipeline_one": sco_pipeline_one,
    "trn_ols_gradient": _gradient("linear_regression"),
    "trn_ridge_gradient": _gradient("ridge_regression"),
    "trn_leafwise_trees": _few_trees("leafwise"),
    "trn_leafwise_predictions": _few_predictions("leafwise"),
    "trn_levelwise_trees": _few_trees("levelwise"),
    "trn_levelwise_predictions": _few_predictions("levelwise"),
    "trn_ols": _training("linear_regression"),
    "trn_ridge": _training("ridge_regression"),
    "trn_forest": _training("random_forest"),
    "trn_gbt": _training("boosted_trees"),
    "trn_gbt_alt": _training("leafwise_trees"),
}
