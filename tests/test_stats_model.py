import math

import pytest
from pyspark.ml import PipelineModel

from sunset_engine.operators import model as M
from sunset_engine.operators import stats as ST

def test_golden_statistics(spark):
    """A published example: Anscombe's first data set (1973), r 0.816, p 0.00217, line y = 3.00 + 0.500 x, R^2 0.667."""
    x = [10, 8, 13, 9, 11, 14, 6, 4, 12, 7, 5]
    y = [8.04, 6.95, 7.58, 8.81, 8.33, 9.96, 7.24, 4.26, 10.84, 4.82, 5.68]
    df = spark.createDataFrame([(float(a), b) for a, b in zip(x, y)] + [(None, 1.0), (2.0, None)], "x double, y double")
    s = ST.summary(df, "x", "y").first()
    assert s.n == 11 and s.pearson_r == pytest.approx(0.81642051634484, abs=1e-12)
    assert s.slope == pytest.approx(0.500090909090909, abs=1e-12) and s.intercept == pytest.approx(3.00009090909091, abs=1e-12)
    assert s.r2 == pytest.approx(0.666542459508775, abs=1e-12)
    assert ST.pearson_p_value(df, "x", "y").first().p_value == pytest.approx(0.00216962887307879, abs=1e-12)


def test_constant_column_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert ST.pearson(df, "x", "y").first().pearson_r is None
    assert ST.line_fit(df, "x", "y").first().slope is None


def test_residuals_and_metrics(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i + 1.0) for i in range(10)], "k int, x double, y double")
    res = ST.fit_residuals(df, "x", "y", ["k"]).collect()
    assert max(abs(r.residual) for r in res) < 1e-9
    m = ST.regression_metrics(ST.fit_residuals(df, "x", "y", ["k"]), "y", "fitted").first()
    assert m.rmse < 1e-9 and m.mae < 1e-9 and m.r2 == pytest.approx(1.0)


def _table(spark, n=40):
    rows = [(f"A{i:02d}", (i % 7) / 7.0, 100 + 10 * i, 5 * (i % 3), (i % 7) / 700.0 + 0.001) for i in range(n)]
    return spark.createDataFrame(rows, "airport_id string, bird_population double, flight_count long, "
                                       "bird_strike_count long, bird_flight_ratio double")


def test_forest_fit_predict_save(spark, tmp_dir):
    data = M.prepare(_table(spark))
    train, test = M.split(data, key="airport_id")
    assert train.count() + test.count() == 40
    model = M.fit_forest(train, numTrees=10)
    pred = M.predictions(model, test)
    assert pred.columns == ["airport_id", "bird_population", "flight_count", "bird_flight_ratio", "prediction"]
    metrics = M.evaluate(pred)
    res = M.residuals(pred).collect()
    assert all(abs(r.residual - (r.bird_flight_ratio - r.prediction)) < 1e-15 for r in res)
    assert set(metrics) == {"rmse", "mse", "mae", "r2"} and metrics["rmse"] >= 0
    M.save(model, f"{tmp_dir}/model")
    M.save(model, f"{tmp_dir}/model")  # overwrite
    again = PipelineModel.load(f"{tmp_dir}/model")
    assert again.transform(test).count() == test.count()


def test_cross_validation_small_grid(spark):
    data = M.prepare(_table(spark))
    train, test = M.split(data, key="airport_id")
    cv = M.cross_validate(train, trees=(5, 10), depths=(2,), folds=3)
    assert len(cv.avgMetrics) == 2
    assert M.predictions(cv.bestModel, test).count() == test.count()


def test_t_test_p_value_properties(spark):
    rows = [(0.0, 50), (1.0, 50), (None, 50), (0.3, 2), (0.3, 40), (-0.3, 40), (0.1, 40), (0.6, 40)]
    # large samples: t = 1.959964 gives the normal two-sided 5 %, at every size alike
    rows += [(1.959964 / math.sqrt(n - 2 + 1.959964**2), n) for n in (10**7 - 1, 10**7 + 3, 10**9)]
    # one and two degrees of freedom have closed forms
    rows += [(t / math.sqrt(1 + t * t), 3) for t in (0.5, 100.0)] + [(t / math.sqrt(2 + t * t), 4) for t in (2.0, 30.0)]
    df = spark.createDataFrame([(i, r, n) for i, (r, n) in enumerate(rows)], "i int, r double, n long")
    p = [x.p for x in df.select("i", ST.t_test_p_value("r", "n").alias("p")).orderBy("i").collect()]
    assert p[0] == pytest.approx(1.0) and p[1] == 0.0 and p[2] is None and p[3] is None
    assert p[4] == pytest.approx(p[5]) and p[6] > p[4] > p[7]
    assert p[8:11] == [pytest.approx(0.05, abs=1e-6)] * 3
    assert p[11:13] == [pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-9) for t in (0.5, 100.0)]
    assert p[13:] == [pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-8) for t in (2.0, 30.0)]
