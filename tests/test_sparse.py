"""Sparse one-hot encoding."""

from fareweave.operators.sparse import as_vectors, category_places, sparse_one_hot
from pyspark.sql import functions as F


def test_places_and_positions(spark):
    rows = [(1, "b", 2), (2, "a", None), (3, None, 10), (4, "é", 2), (5, "", None), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, x string, y int").repartition(4)
    places = category_places(df, ["y", "x"])
    got = {(r.column_name, r.category): r.place for r in places.collect()}
    # Sorted as text: "10" before "2".
    assert got == {("y", "10"): 0, ("y", "2"): 1, ("x", ""): 2, ("x", "a"): 3, ("x", "b"): 4, ("x", "é"): 5}
    found = {r.id: (list(r.positions), r.size) for r in sparse_one_hot(df, ["y", "x"], places).collect()}
    assert found == {1: ([1, 4], 6), 2: ([3], 6), 3: ([0], 6), 4: ([1, 5], 6), 5: ([2], 6), 6: ([], 6)}


def test_unknown_values_and_no_rows(spark):
    places = category_places(spark.createDataFrame([("a",)], "x string"), ["x"])
    new = spark.createDataFrame([(1, "z", 0), (2, "a", 0)], "id int, x string, place int")
    out = sparse_one_hot(new, ["x"], places)
    assert out.columns == ["id", "place", "positions", "size"]
    assert {r.id: list(r.positions) for r in out.collect()} == {1: [], 2: [0]}
    empty = spark.createDataFrame([], "x string")
    assert sparse_one_hot(empty, ["x"], category_places(empty, ["x"])).collect() == []


def test_a_hundred_thousand_categories(spark):
    df = spark.range(200_000).select("id", F.format_string("c%06d", F.col("id") % 100_000).alias("x"), F.lit("only").alias("y"))
    places = category_places(df, ["x", "y"])
    assert places.count() == 100_001
    wrong = places.where((F.col("column_name") == "x") & (F.substring("category", 2, 6).cast("long") != F.col("place")))
    assert wrong.count() == 0
    out = sparse_one_hot(df, ["x", "y"], places)
    assert out.where((F.element_at("positions", 1) != F.col("id") % 100_000) | (F.element_at("positions", 2) != 100_000)).count() == 0
    vector = as_vectors(out.where("id = 7")).first().features
    assert vector.size == 100_001 and vector.indices.tolist() == [7, 100_000] and vector.values.tolist() == [1.0, 1.0]
