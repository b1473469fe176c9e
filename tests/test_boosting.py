"""The histogram learner against a plain one, and its limits."""

import dataclasses

import numpy as np
import pytest
from fareweave.plans import boosting as B
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

SMALL = B.TreeSettings(rounds=3, learning_rate=0.3, leaves=6, max_depth=4, min_leaf=5, l2=0.5, bins=32)


def plain(x, y, cuts, settings):
    """One leaf at a time, every cut of every feature tried; returns predictions and (feature, cut) per tree."""
    f = np.full(len(y), y.mean())
    trees = []
    for _ in range(settings.rounds):
        g = y - f
        leaves, splits = [(np.arange(len(y)), 0)], []

        def best(rows):
            found = None
            for j in range(x.shape[1]):
                for c in cuts[j]:
                    below = x[rows, j] <= c
                    n, m = below.sum(), (~below).sum()
                    if min(n, m) >= settings.min_leaf and len(rows) >= settings.min_split:
                        a, b = g[rows][below].sum(), g[rows][~below].sum()
                        gain = a * a / (n + settings.l2) + b * b / (m + settings.l2) - (a + b) ** 2 / (len(rows) + settings.l2)
                        if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                            found = (gain, j, c, below)
            return found

        while len(leaves) < (settings.leaves or 10**9):
            options = [(best(rows), i) for i, (rows, depth) in enumerate(leaves) if depth < settings.max_depth]
            options = [(o, i) for o, i in options if o is not None]
            if not options:
                break
            (gain, j, c, below), i = max(options, key=lambda o: o[0][0])
            rows, depth = leaves.pop(i)
            leaves += [(rows[below], depth + 1), (rows[~below], depth + 1)]
            splits.append((j, c))
        for rows, _ in leaves:
            f[rows] += settings.learning_rate * g[rows].sum() / (len(rows) + settings.l2)
        trees.append(sorted(splits))
    return f, trees


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(4)
    x = np.column_stack([random.integers(0, 12, 700), random.normal(size=700).round(2), random.integers(0, 3, 700)]).astype(float)
    y = np.sin(x[:, 0]) + (x[:, 1] > 0.3) * x[:, 2] + 0.1 * random.normal(size=700)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    return df.repartition(5), x, y


@pytest.mark.parametrize(
    "change",
    [{}, {"leaves": None, "l2": 1.0, "min_leaf": 1}, {"leaves": 3}, {"max_depth": 1}, {"min_split": 200}, {"min_leaf": 90}],
)
def test_trees_of_a_plain_learner(spark, table, change):
    df, x, y = table
    settings = dataclasses.replace(SMALL, **change)
    forest = B.fit_trees(df, ["a", "b", "c"], "y", settings)
    expected, trees = plain(x, y, forest.cuts, settings)
    for tree, splits in zip(forest.trees, trees, strict=True):
        assert sorted((n.feature, forest.threshold(n)) for i, n in enumerate(tree.nodes) if tree.is_split(i)) == splits
    assembled = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df)
    columns = {"featuresCol": "v", "labelCol": "y", "predictionCol": "p"}
    model = B.to_model(spark, forest, settings, 3, columns)
    got = {(r.a, r.b, r.c, r.y): r.p for r in model.transform(assembled).collect()}
    np.testing.assert_allclose([got[(*row, v)] for row, v in zip(x.tolist(), y.tolist())], expected, atol=1e-8)


def test_leaves_hold_the_mean_of_their_rows_and_squares_fall(table):
    df, x, y = table
    settings = dataclasses.replace(SMALL, l2=0.0, learning_rate=1.0, rounds=6)
    forest = B.fit_trees(df, ["a", "b", "c"], "y", settings)
    bins = np.column_stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(forest.cuts)])
    f, before = np.full(len(y), forest.base), np.inf
    for tree in forest.trees:
        leaf = tree.arrays().walk(bins)
        for i in np.unique(leaf):
            assert tree.nodes[i].rows == (leaf == i).sum() >= 5
            assert tree.nodes[i].value == pytest.approx((y - f)[leaf == i].mean(), abs=1e-9)
        f = f + tree.arrays().value[leaf]
        squares = ((y - f) ** 2).sum()
        assert squares < before
        before = squares


def test_one_fit_is_like_another(table):
    df, _, _ = table
    settings = dataclasses.replace(SMALL, row_share=0.7, column_share=0.6, rounds=12)
    first, second = (B.fit_trees(df, ["a", "b", "c"], "y", settings) for _ in range(2))
    assert first.rows() == second.rows()
    features = [{n.feature for i, n in enumerate(t.nodes) if t.is_split(i)} for t in first.trees]
    assert all(len(f) <= 2 for f in features) and len(set().union(*features)) == 3
    sizes = {t.nodes[0].rows for t in first.trees}
    assert len(sizes) > 1 and all(400 < n < 580 for n in sizes)


def test_missing_values_go_with_the_largest(spark):
    rows = [(1.0, 1.0), (2.0, 1.0), (3.0, 5.0), (None, 5.0), (float("nan"), 5.0), (1.0, None), (1.0, float("nan"))]
    df = spark.createDataFrame(rows * 4, "a double, y double")
    settings = B.TreeSettings(rounds=1, learning_rate=1.0, max_depth=1, min_leaf=1, bins=8)
    forest = B.fit_trees(df, ["a"], "y", settings)
    root = forest.trees[0].nodes[0]
    assert root.rows == 20 and forest.threshold(root) == 2.0
    assert [forest.base + forest.trees[0].nodes[i].value for i in (root.left, root.right)] == pytest.approx([1.0, 5.0])


def test_nothing_to_split(spark):
    empty = B.fit_trees(spark.createDataFrame([], "a double, y double"), ["a"], "y", SMALL)
    assert empty.base == 0 and empty.trees == []
    equal = B.fit_trees(spark.createDataFrame([(1.0, 2.0)] * 50, "a double, y double"), ["a"], "y", SMALL)
    assert equal.base == 2.0 and all(len(t.nodes) == 1 and t.nodes[0].value == 0 for t in equal.trees)


def test_model_is_saved_and_read_like_any_other(spark, table, tmp_path):
    df, x, y = table
    learner = B.HistogramBoosting(settings=SMALL).setFeaturesCol("v").setLabelCol("y").setPredictionCol("p")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="v"), learner]).fit(df)
    model.save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    a, b = (sorted(r.p for r in m.transform(df).collect()) for m in (model, again))
    assert a == b
    weights = again.stages[-1].featureImportances.toArray()
    assert weights.sum() == pytest.approx(1) and (weights > 0).all()


def test_full_learner_on_the_given_rides(spark, small):
    """Production settings, few rounds: the squares of the training rows fall from round to round."""
    from fareweave import config
    from fareweave.plans.prepare import prepare
    from fareweave.plans.training import predict_with, train_model
    from fareweave.sources.events import load_rides

    prepared = prepare(load_rides(spark, small))
    errors = []
    for rounds in (1, 4, 10):
        params = {**next(e for e in config.EXPERIMENTS if e["kind"] == "LeafwiseBoosting")["params"], "rounds": rounds}
        run = train_model("l", "LeafwiseBoosting", params, prepared.part("train"), list(prepared.state.features))
        scored = predict_with(run, prepared.part("train"))
        errors.append(scored.agg(F.avg((F.col("prediction_l") - F.col(config.TARGET)) ** 2)).first()[0])
    assert errors == sorted(errors, reverse=True) and errors[2] < errors[0] / 2


def test_rows_are_drawn_by_sparks_hash(spark):
    ids = [0, 1, -1, 2**40, 2**63 - 1, -(2**63), 8589934592]
    expected = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(F.xxhash64("i", F.lit(42), F.lit(7))).collect()]
    assert B._hash(np.array(ids), 42, 7).astype(np.int64).tolist() == expected


def test_a_pass_is_one_job_over_kept_rows(spark, table):
    """Trees of depth d take d passes each; besides, a few jobs prepare the rows and, after ten trees, store their margins."""
    df, _, _ = table
    settings = dataclasses.replace(SMALL, rounds=12, max_depth=3, row_share=0.8)

    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"boosting-{rounds}", "")
        forest = B.fit_trees(df, ["a", "b", "c"], "y", dataclasses.replace(settings, rounds=rounds))
        assert len(forest.trees) == rounds
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosting-{rounds}"))

    assert jobs(12) - jobs(2) <= 10 * 3 + 1


def test_features_of_a_group_are_counted_together():
    random = np.random.default_rng(3)
    widths = (33, 3, 300, 33, 3, 5000, 12, 33)
    packing = B.Packing(widths)
    assert sorted(f for g in packing.groups for f in g) == list(range(len(widths))) and len(packing.groups) < 6
    assert all(packing.cells(g) <= B.CELLS or len(g) == 1 for g in packing.groups)
    bins = [random.integers(0, w, 5000) for w in widths]
    residuals = random.integers(-(2**45), 2**45, 5000)
    codes, tables = packing.codes(bins), packing.tables(2)
    for some in (slice(0, 4000), slice(4000, 5000)):
        packing.add(tables, 1, codes[:, some], residuals[some])
    found = packing.by_feature(tables)
    assert not found[0].any()
    for feature, own in enumerate(bins):
        for b in range(widths[feature]):
            assert found[1, feature, :, b].tolist() == [(own == b).sum(), residuals[own == b].sum()]
        tree = B.TreeArrays(*(np.array(c) for c in ([feature, 0, 0], [widths[feature] // 2, 0, 0], [1, -1, -1], [2, -1, -1], [0.0, 1.0, 2.0])))
        rows = np.flatnonzero(residuals > 0)
        assert packing.router(tree)(codes, 0, rows).tolist() == (own[rows] <= widths[feature] // 2).tolist()


BOOSTED = {"learning_rate": 0.3, "max_depth": 4, "row_share": 1.0, "column_share": 1.0, "seed": 7}


def boosted(df, columns, rounds, **change):
    from fareweave.plans.training import predict_with, train_model

    run = train_model("g", "GradientBoosting", {**BOOSTED, "rounds": rounds, **change}, df, columns, "y")
    return run, [r.prediction_g for r in predict_with(run, df).orderBy("i").collect()]


def test_boosted_trees_are_those_of_spark_ml(spark):
    """Without draws, and with a bin for each value, the trees are the same; so are their number and weights."""
    from pyspark.ml.regression import GBTRegressor

    random = np.random.default_rng(8)
    x = random.integers(0, 9, (900, 4)).astype(float)
    y = np.sin(x[:, 0]) + (x[:, 1] > 3) * x[:, 2] + 0.3 * random.normal(size=900)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, d double, y double").repartition(4)
    run, got = boosted(df, ["a", "b", "c", "d"], 6)
    assembled = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="v").transform(df)
    learner = GBTRegressor(featuresCol="v", labelCol="y", maxIter=6, maxDepth=4, stepSize=0.3, maxBins=32, seed=7)
    model = learner.fit(assembled)
    expected = [r.prediction for r in model.transform(assembled).orderBy("i").collect()]
    np.testing.assert_allclose(got, expected, atol=1e-8)
    assert run.model.stages[-1].treeWeights == model.treeWeights == [1.0] + [0.3] * 5
    assert [t.numNodes for t in run.model.stages[-1].trees] == [t.numNodes for t in model.trees]


def test_boosted_trees_draw_features_for_each_node(spark):
    random = np.random.default_rng(9)
    rows = [(i, *map(float, random.integers(0, 9, 4)), float(random.normal())) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, d double, y double")
    settings = B.TreeSettings(rounds=3, leaves=None, min_leaf=1, max_depth=4, column_share=0.5, by_node=True, first_whole=True)
    first, second = (B.fit_trees(df, ["a", "b", "c", "d"], "y", settings) for _ in range(2))
    assert first.rows() == second.rows()
    assert all(len({n.feature for i, n in enumerate(t.nodes) if t.is_split(i)}) > 2 for t in first.trees)


@pytest.mark.parametrize("gap", [None, float("nan"), float("inf")])
def test_boosted_trees_refuse_rows_without_a_target(spark, gap):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, gap), (2, 3.0, 2.0)], "i int, a double, y double")
    with pytest.raises(ValueError, match="must not be null"):
        boosted(df, ["a"], 1)


def test_a_round_of_boosted_trees_is_a_stage_a_level(spark):
    """No shuffle adds up the tables of a level, and margins take no stage of their own."""
    rows = [(i, float(i % 17), float(i % 13), float((i * i) % 19)) for i in range(800)]
    df = spark.createDataFrame(rows, "i int, a double, b double, y double").repartition(4)
    tracker = spark.sparkContext.statusTracker()

    def stages(rounds):
        spark.sparkContext.setJobGroup(f"boosted-{rounds}", "")
        boosted(df, ["a", "b"], rounds, max_depth=3)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"boosted-{rounds}")]
        found = [tracker.getStageInfo(i) for i in {i for job in jobs if job for i in job.stageIds}]
        return sum(1 for s in found if s and s.numCompletedTasks)

    assert stages(7) - stages(2) <= 5 * 3 + 2
