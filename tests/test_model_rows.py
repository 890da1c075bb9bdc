"""Folds, splits, saved forests and forests as rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sunset_engine.operators import forest as FO
from sunset_engine.operators import model as M
from sunset_engine.sources import csvio


def _table(spark, n=60):
    draw = random.Random(2)
    rows = [(f"A{i:02d}", draw.random(), draw.randint(50, 500), draw.random() / 50) for i in range(n)]
    return spark.createDataFrame(rows, "airport_id string, bird_population double, flight_count long, bird_flight_ratio double")


def test_walking_the_nodes_equals_transform(spark, tmp_dir):
    data = M.prepare(_table(spark))
    for trees, depth in ((12, 5), (1, 0), (7, 9)):
        model = M.fit_forest(data, numTrees=trees, maxDepth=depth)
        M.save(model, f"{tmp_dir}/f{trees}")
        nodes = FO.node_table(spark, f"{tmp_dir}/f{trees}")
        assert nodes.schema.simpleString() == f"struct<{FO.NODE.replace(' ', ':').replace(',:', ',')}>"
        more = spark.createDataFrame([("X", 0.5, 200, 0.0), ("Y", -1.0, 10**6, 0.0)], "airport_id string, bird_population double, flight_count long, bird_flight_ratio double")
        rows = data.unionByName(more)
        want = {r.airport_id: r.prediction for r in model.transform(rows).collect()}
        got = {r.airport_id: r.prediction for r in FO.score(rows, nodes, list(M.FEATURES), depth).collect()}
        assert got == pytest.approx(want, rel=1e-15) and len(got) == 62


def test_a_forest_must_be_whole_and_bounded(spark, monkeypatch):
    leaf = (0, 0, None, None, None, None, 1.0)
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(ValueError, match="numbered"):
        FO.score(df, spark.createDataFrame([leaf, (0, 2, None, None, None, None, 1.0)], FO.NODE), ["x"], 3)
    with pytest.raises(ValueError, match="0 nodes"):
        FO.score(df, spark.createDataFrame([], FO.NODE), ["x"], 3)
    nodes = spark.createDataFrame([(4, 0, 0, 0.5, 1, 2, 9.0), (4, 1, None, None, None, None, 1.0), (4, 2, None, None, None, None, 2.0), (*leaf[:6], 4.0)], FO.NODE)
    assert [r.prediction for r in FO.score(df, nodes, ["x"], 1).collect()] == [3.0, 3.0]
    monkeypatch.setattr(FO, "MAX_NODES", 3)
    with pytest.raises(ValueError, match="4 nodes"):
        FO.score(df, nodes, ["x"], 1)


def test_loaded_model_predicts_the_same(spark, tmp_dir):
    data = M.prepare(_table(spark))
    model = M.fit_forest(data, numTrees=6)
    M.save(model, f"{tmp_dir}/m")
    assert M.predictions(M.load(f"{tmp_dir}/m"), data).collect() == M.predictions(model, data).collect()


def test_folds_by_key_and_scores_from_stored_predictions(spark):
    train = M.prepare(_table(spark))
    grid = ((4, 2), (6, 3))
    cv = M.cross_validate(train, trees=(4, 6), depths=(2, 3), folds=3, key="airport_id")
    made = M.out_of_fold(train, "airport_id", grid=grid, folds=3)
    by_key = {r.airport_id: r.f for r in train.select("airport_id", M.fold_of("airport_id", 3).alias("f")).collect()}
    assert {(r.airport_id, r.fold) for r in made.collect()} == set(by_key.items()) and made.count() == 120
    want = {(r.num_trees, r.max_depth): r.avg_rmse for r in M.cv_scores(cv).collect()}
    got = {(r.num_trees, r.max_depth): r.avg_rmse for r in M.averaged_scores(made).collect()}
    assert set(got) == set(grid) and got == pytest.approx({k: want[k] for k in grid}, rel=1e-12)
    assert len(M.fold_scores(made).collect()) == 6
    # However the rows lie, a key has its fold.
    again = train.repartition(7).select("airport_id", M.fold_of("airport_id", 3).alias("f")).collect()
    assert {r.airport_id: r.f for r in again} == by_key


def test_split_without_a_key_does_not_depend_on_partitions(spark):
    rows = [(i % 7, None if i % 5 == 0 else f"x{i % 3}", i % 2 / 4) for i in range(1500)]
    parts = []
    for n in (1, 8, 211):
        train, test = M.split(spark.createDataFrame(rows, "a int, b string, c double").repartition(n))
        parts.append((Counter(map(tuple, train.collect())), Counter(map(tuple, test.collect()))))
    assert parts[0] == parts[1] == parts[2]
    assert parts[0][0] + parts[0][1] == Counter(rows)
    assert 0.6 < sum(parts[0][0].values()) / 1500 < 0.8 and all(v < 1500 for v in parts[0][0].values())
    assert len(parts[0][0]) > 40                  # copies of a row fall on both sides


def test_copies_of_one_row_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "RUN_COPIES", 100)
    same = spark.range(5000).select(F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"))
    numbered = M.numbered_copies(same.unionAll(same.limit(250).withColumn("a", F.lit("y"))))
    got = numbered.withColumn("task", F.spark_partition_id()).collect()
    assert Counter((r.a, r[M.COPY]) for r in got) == Counter([("x", k + 1) for k in range(5000)] + [("y", k + 1) for k in range(250)])
    by_task = Counter(r.task for r in got)
    assert len(by_task) >= 4 and max(by_task.values()) < 5250 / 2


def test_prepared_table_is_one_partition_up_to_its_bound(spark):
    assert M.prepare(_table(spark)).rdd.getNumPartitions() == 1
    large = M.prepare(_table(spark), max_rows=20)
    assert large.rdd.getNumPartitions() == 3 and large.count() == 60


def test_header_lines_anywhere_are_dropped(spark, tmp_dir):
    head = ",".join(csvio.FLIGHT_COLUMNS)
    line = "2023-10-01,\"A, Inc.\",JFK,LAX,False,False,0,{}.0,0,0,900.0"
    for name, lines in (("a", [head, line.format(800), head, line.format(801)]), ("b", [head, line.format(802)]), ("c", [line.format(803), head])):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
    got = csvio.read_flights(spark, f"{tmp_dir}/[ab].csv").collect()
    assert sorted(r.dep_time for r in got) == ["800.0", "801.0", "802.0"]
    assert csvio.read_flights(spark, tmp_dir, header=False).count() == 8
    open(f"{tmp_dir}/empty.txt", "w").close()
    assert csvio.read_flights(spark, f"{tmp_dir}/empty.txt").collect() == []


def test_inferred_types_and_declared_fallback(spark, tmp_dir):
    with open(f"{tmp_dir}/t.csv", "w") as f:
        f.write("airport_id,bird_population,flight_count,bird_strike_count,bird_flight_ratio\nDEN,0.5,10,,\nATL,0.25,20,,\n")
    df = csvio.read_training(spark, f"{tmp_dir}/t.csv")
    assert dict(df.dtypes) == {"airport_id": "string", "bird_population": "double", "flight_count": "int", "bird_strike_count": "double", "bird_flight_ratio": "double"}
    rows = {r.name: (r.position, r.type, r.n_values) for r in csvio.column_types(df).collect()}
    assert rows["flight_count"] == (2, "int", 2) and rows["bird_strike_count"] == (3, "double", 0)


def test_tile_folders_are_pruned(spark, tmp_dir):
    cells = spark.range(1000).select(F.col("id").cast("int").alias("row"), F.lit(1).alias("col"), F.lit(1.0).alias("value"))
    csvio.write_cells(cells, f"{tmp_dir}/cells")
    back = csvio.read_cells(spark, f"{tmp_dir}/cells")
    assert back.count() == 1000 and {r.tile_row for r in back.select("tile_row").distinct().collect()} == {0, 1, 2, 3}
    plan = back.where("tile_row = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tile_row" in plan and back.where("tile_row = 2").inputFiles()
