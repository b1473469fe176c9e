"""Default settings of the ride-pricing pipeline.

Values below are fixed values: results must agree with them.
"""

from __future__ import annotations

TARGET = "price_multiplier"
ID_COLUMNS = ["ride_id", "timestamp"]
CATEGORICAL_COLUMNS = ["weather_condition"]

TEST_SHARE = 0.2
SEED = 42

# Model experiments: name, learner kind, parameters.
EXPERIMENTS = [
    {"name": "linear_regression", "kind": "LinearRegression", "params": {}},
    {"name": "ridge_regression", "kind": "Ridge", "params": {"alpha": 1.0}},
    {
        "name": "random_forest",
        "kind": "RandomForest",
        "params": {"trees": 100, "max_depth": 12, "min_leaf": 5, "seed": 42},
    },
    {
        "name": "boosted_trees",
        "kind": "GradientBoosting",
        "params": {
            "rounds": 150,
            "max_depth": 6,
            "learning_rate": 0.1,
            "row_share": 0.8,
            "column_share": 0.8,
            "seed": 42,
        },
    },
    {
        "name": "leafwise_trees",
        "kind": "LeafwiseBoosting",
        "params": {
            "rounds": 150,
            "max_depth": 6,
            "learning_rate": 0.1,
            "row_share": 0.8,
            "column_share": 0.8,
            "seed": 42,
        },
    },
]

MULTIPLIER_RANGE = (1.0, 3.0)

# Drift defaults: score threshold, p-value threshold,
# most distinct values of a numeric column still compared as categories,
# number of drifted columns that raises an alert under the "min_features" policy.
DRIFT_THRESHOLD = 0.1
DRIFT_P_VALUE = 0.05
FEW_VALUES = 5
ALERT_FEATURES = 3
