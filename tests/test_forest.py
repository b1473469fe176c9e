"""The forest against Spark ML's, its passes, and what its tasks count."""

import numpy as np
import pytest
from fareweave.plans import forest as R
from fareweave.plans.training import predict_with, train_model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(8)
    x = np.column_stack([random.integers(0, 9, 1500), random.normal(size=1500), random.random(1500) < 0.01, random.integers(0, 60, 1500)]).astype(float)
    y = 40 + np.sin(x[:, 0]) + (x[:, 1] > 0.3) * x[:, 0] + x[:, 2] + 0.3 * random.normal(size=1500)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "i int, a double, b double, c double, d double, y double").repartition(4).cache()


def trained(df, **params):
    run = train_model("f", "RandomForest", {"trees": 1, "seed": 7, **params}, df, COLUMNS, "y")
    return run.model.stages[-1], [r.prediction_f for r in predict_with(run, df).orderBy("i").collect()]


def splits(model):
    return [line.strip() for line in model.toDebugString.split("\n")[1:] if "Predict" not in line]


@pytest.mark.parametrize("depth", [1, 7, 14])
def test_trees_are_those_of_spark_ml(table, depth):
    """Without draws: the same features and thresholds, the same predictions. Small leaves would leave ties to rounding."""
    model, got = trained(table, max_depth=depth, min_leaf=20, bootstrap=False)
    assembled = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(table)
    learner = RandomForestRegressor(
        featuresCol="v", labelCol="y", numTrees=1, maxDepth=depth, minInstancesPerNode=20, featureSubsetStrategy="all", bootstrap=False
    )
    expected = learner.fit(assembled)
    assert splits(model) == splits(expected) and len(splits(model)) > 2
    np.testing.assert_allclose(got, [r.prediction for r in expected.transform(assembled).orderBy("i").collect()], atol=1e-7)
    np.testing.assert_allclose(model.featureImportances.toArray(), expected.featureImportances.toArray(), atol=1e-7)


def test_a_forest_is_the_mean_of_its_trees_and_as_good_as_spark_mls(table):
    model, got = trained(table, trees=20, max_depth=6)
    assert model.getNumTrees == 20 == len(model.trees)
    assembled = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(table)
    one = assembled.orderBy("i").first()
    assert got[0] == pytest.approx(np.mean([t.predict(one.v) for t in model.trees]), abs=1e-12)
    learner = RandomForestRegressor(featuresCol="v", labelCol="y", numTrees=20, maxDepth=6, minInstancesPerNode=5, featureSubsetStrategy="all", seed=7)
    other = np.array([r.prediction for r in learner.fit(assembled).transform(assembled).orderBy("i").collect()])
    y = np.array([r.y for r in table.orderBy("i").collect()])
    assert np.mean((np.array(got) - y) ** 2) == pytest.approx(np.mean((other - y) ** 2), rel=0.05)
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) == 20


def test_a_level_of_many_trees_is_one_job(spark, table):
    """However many nodes it has: the tables of a task's nodes are counted one part after the other."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(depth):
        spark.sparkContext.setJobGroup(f"forest-{depth}", "")
        train_model("f", "RandomForest", {"trees": 40, "max_depth": depth, "min_leaf": 1, "memory_mb": 4}, table, COLUMNS, "y")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"forest-{depth}"))

    assert jobs(10) - jobs(2) <= 8


def test_draws_are_poissons_and_differ_by_tree():
    ids = np.arange(1 << 17)
    first, again, other = R.draws(ids, 42, 0), R.draws(ids, 42, 0), R.draws(ids, 42, 1)
    assert (first == again).all() and np.corrcoef(first, other)[0, 1] == pytest.approx(0, abs=0.02)
    for times, share in enumerate([0.36788, 0.36788, 0.18394, 0.06131, 0.01533]):
        assert np.mean(first == times) == pytest.approx(share, abs=0.005)
    assert first.max() <= 12 < 1 << R.DRAW_BITS


def test_distributions_keep_few_values_and_bound_the_ranks_of_many(spark):
    few = R.Values.joined([R.Values.of(np.array(v)) for v in ([1.0, 1.0, 5.0], [2.0, np.nan, 1.0])])
    assert (few.at.tolist(), few.rows.tolist(), few.missing) == ([1.0, 2.0, 5.0], [3, 1, 1], 1)
    assert few.cuts(32) == [1.5, 3.5]
    random = np.random.default_rng(2)
    parts = [random.normal(size=40_000) for _ in range(4)]
    many = R.Values.joined([R.Values.of(p) for p in parts])
    everything = np.sort(np.concatenate(parts))
    assert len(many.at) <= R.SUMMARY + 1 and many.rows.sum() == len(everything)
    ranks = np.searchsorted(everything, many.cuts(32)) / len(everything)
    np.testing.assert_allclose(ranks, np.arange(1, 32) / 32, atol=3 / R.SUMMARY)
    df = spark.range(1000).selectExpr("id % 7 * 1.0 a", "case when id = 5 then null else 0.5 end b")
    a, b = R.distributions(df, ["a", "b"])
    assert a.rows.tolist() == [143] * 6 + [142] and (b.at.tolist(), b.rows.tolist(), b.missing) == ([0.5], [999], 1)


@pytest.mark.parametrize("memory", [0, 1 << 20])
def test_children_are_counted_or_the_rest_of_their_parents(memory):
    """Tables of the grandchildren of the root, against a plain count."""
    random = np.random.default_rng(3)
    rows, layout = 5000, R.Layout((5, 2, 40, 2, 9))
    bins = [random.integers(0, w, rows) for w in layout.widths]
    partition = R.Partition(np.arange(rows), random.integers(-(2**31), 2**31, rows).astype(float), layout.packing.codes(bins))
    sample = partition.sample(range(3, 4), R.ForestSettings())
    times = sample.places[0].astype(int) & 15
    assert (times == R.draws(np.arange(rows), 42, 3)).all()

    def tables(sample, step, parents=()):
        records = [*R.counted(sample, [step], 3, layout, memory), *parents]
        return dict(R.gathered(records, {3: step}, layout))[3]

    def expected(here):
        return [[np.bincount(b[here], (times * v)[here], w) for b, w in zip(bins, layout.widths)] for v in (1, partition.target)]

    level = tables(sample, R.ROOT)
    nodes = [np.ones(rows, dtype=bool)]
    for feature, cut, right in (([2], [17], [True]), ([4, 0], [3, 2], [False, True])):
        step = R.Step(np.array(feature), np.array(cut), 1 + 2 * np.arange(len(feature)), np.array(right))
        sample = R.moved(sample, [step], layout)
        level = tables(sample, step, [(3, level[:, step.parents])])
        nodes = [n & side for n, f, c in zip(nodes, feature, cut) for side in (bins[f] <= c, bins[f] > c)]
        for i, here in enumerate(nodes):
            for kind in (0, 1):
                assert level[kind, i].tolist() == np.concatenate(expected(here)[kind]).tolist()


@pytest.mark.parametrize("gap", [None, float("nan"), float("inf")])
def test_rows_without_a_target_are_refused(spark, gap):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, gap), (2, 3.0, 2.0)], "i int, a double, y double")
    with pytest.raises(ValueError, match="must not be null"):
        train_model("f", "RandomForest", {"trees": 2}, df, ["a"], "y")


def test_missing_values_go_with_the_largest_and_equal_targets_are_a_leaf(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 5.0), (None, 5.0), (float("nan"), 5.0)] * 4, "a double, y double")
    settings = R.ForestSettings(trees=1, max_depth=3, min_leaf=1, bootstrap=False)
    forest = R.fit_forest(df, ["a"], "y", settings)
    tree = forest.trees[0]
    assert tree.rows.tolist() == [20, 8, 12] and forest.cuts[0][tree.bin[0]] == 2.5
    assert (forest.middle + tree.total / forest.scale / tree.rows).tolist() == pytest.approx([3.4, 1.0, 5.0])
    equal = R.fit_forest(spark.createDataFrame([(float(i), 0.1) for i in range(50)], "a double, y double"), ["a"], "y", settings)
    assert equal.trees[0].rows.tolist() == [50] and equal.middle + equal.trees[0].total[0] / equal.scale / 50 == pytest.approx(0.1)
