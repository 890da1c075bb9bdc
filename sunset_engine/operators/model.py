"""Random-forest regression of strikes per flight on bird population and traffic (M1-M9).

The training table has one row per airport, so it is bounded by the number of
airports, not by the flight volume. It is written once before fitting:
cross-validation runs 46 fits, and each must read the small table, not
recompute the whole flight pipeline.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.operators.joins import materialize, spread

# The reference model setup.
FEATURES = ("bird_population", "flight_count")
LABEL = "bird_flight_ratio"
FOREST = dict(numTrees=100, maxDepth=5, maxBins=32, seed=42)
GRID_TREES = (50, 100, 150)
GRID_DEPTH = (5, 10, 15)
FOLDS = 5
SEED = 42
TRAIN_FRACTION = 0.7
# Airports are some 80,000 rows: a larger table than this is not one partition.
ONE_PARTITION_ROWS = 500_000
COPY, FIRST, FOLD = "_copy", "_first", "_fold"
# Copies of a row that one task numbers together.
RUN_COPIES = 10_000


def prepare(df: DataFrame, max_rows: int = ONE_PARTITION_ROWS) -> DataFrame:
    """Drop rows with any NULL (F9), write the table once (lineage cut) and cache it.

    The table has one row per airport. Up to ``max_rows`` it is one sorted partition, so that each of the
    ~500 small jobs of a cross-validation runs one task; a larger one is sorted into ranges of about that many rows.
    Bagging depends on rows' places, which are the same on any cluster for one partition.
    """
    table = materialize(df.na.drop(), "training")
    rows = table.count()
    parted = table.repartition(1) if rows <= max_rows else table.repartitionByRange(-(-rows // max_rows), *table.columns)
    return parted.sortWithinPartitions(*table.columns).cache()


def _share(*parts: Column | str, of: int) -> Column:
    """0 to ``of`` - 1 by the MD5 of the parts joined by colons."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % of


def split(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SEED,
          key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """70/30 split (M6) that depends on the rows alone, not on how they are partitioned.

    With ``key`` its hash decides. Without, the hash of the whole row and, of rows that repeat,
    the number of the copy, so that copies are split in proportion as well.
    """
    if key is None:
        marked = numbered_copies(df)
        bucket = _share(str(seed), F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]), {"ignoreNullFields": "false"}), F.col(COPY).cast("string"), of=1000)
        return marked.where(bucket < int(fraction * 1000)).drop(COPY), marked.where(bucket >= int(fraction * 1000)).drop(COPY)
    bucket = _share(str(seed), F.col(key).cast("string"), of=1000)
    return df.where(bucket < int(fraction * 1000)), df.where(bucket >= int(fraction * 1000))


def numbered_copies(df: DataFrame) -> DataFrame:
    """``df`` with the number of each row among the rows equal to it, from 1: counted before the shuffle, then told apart again."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(COPY))
    # A few rows may have most of the copies: they are dealt in runs of bounded length.
    last = F.least(F.col(COPY), F.col(FIRST) + (RUN_COPIES - 1))
    runs = counted.withColumn(FIRST, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPY), F.lit(RUN_COPIES).cast("long")))).withColumn(COPY, last)
    dealt = spread(runs, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.withColumn(COPY, F.explode(F.sequence(F.col(FIRST), F.col(COPY)))).drop(FIRST)


def fold_of(key: Column | str, folds: int = FOLDS, seed: int = SEED) -> Column:
    """The fold of a row by the hash of its key (M4), another hash than the split's: 0 to ``folds`` - 1."""
    return _share("fold", str(seed), (F.col(key) if isinstance(key, str) else key).cast("string"), of=folds).cast("int")


def forest_pipeline(features=FEATURES, label: str = LABEL, **params) -> tuple[Pipeline, RandomForestRegressor]:
    """Assembler then forest (M1-M3)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    rf = RandomForestRegressor(labelCol=label, featuresCol="features", **{**FOREST, **params})
    return Pipeline(stages=[assembler, rf]), rf


def fit_forest(train: DataFrame, features=FEATURES, label: str = LABEL, **params) -> PipelineModel:
    pipeline, _ = forest_pipeline(features, label, **params)
    return pipeline.fit(train)


def cross_validate(train: DataFrame, features=FEATURES, label: str = LABEL, trees=GRID_TREES, depths=GRID_DEPTH,
                   folds: int = FOLDS, seed: int = SEED, parallelism: int | None = None, key: str | None = None) -> CrossValidatorModel:
    """Grid over trees x depth with k-fold CV on RMSE (M4, M5); ``bestModel`` is refit on all of ``train`` (M9).

    With ``key`` the folds are those of ``fold_of``; a fold without rows is an error. As many fits run
    at once as the session has slots, unless ``parallelism`` says otherwise.
    """
    parallelism = parallelism or train.sparkSession.sparkContext.defaultParallelism
    pipeline, rf = forest_pipeline(features, label)
    grid = ParamGridBuilder().addGrid(rf.numTrees, list(trees)).addGrid(rf.maxDepth, list(depths)).build()
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        seed=seed, parallelism=parallelism)
    if key:
        train = train.withColumn(FOLD, fold_of(key, folds, seed))
        cv = cv.setFoldCol(FOLD)
    return cv.fit(train)


def cv_scores(model: CrossValidatorModel) -> DataFrame:
    """The grid's averages as rows: (num_trees, max_depth, avg_rmse, std_rmse)."""
    rows = []
    for params, mean, std in zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics, strict=True):
        by = {p.name: v for p, v in params.items()}
        rows.append((by["numTrees"], by["maxDepth"], float(mean), float(std)))
    return SparkSession.active().createDataFrame(rows, "num_trees int, max_depth int, avg_rmse double, std_rmse double")


def out_of_fold(train: DataFrame, key: str, features=FEATURES, label: str = LABEL, grid=((FOREST["numTrees"], FOREST["maxDepth"]),),
                folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Predictions of every row by the forest that did not see its fold: (num_trees, max_depth, fold, key, label, prediction).

    One fit per fold and entry of ``grid`` (trees, depth), the same as ``cross_validate`` makes with ``key``.
    The predictions are written, so the scores can be taken from them again.
    """
    marked = train.withColumn(FOLD, fold_of(key, folds, seed))
    parts = []
    for trees, depth in grid:
        for k in range(folds):
            model = fit_forest(marked.where(F.col(FOLD) != k), features, label, numTrees=trees, maxDepth=depth)
            made = model.transform(marked.where(F.col(FOLD) == k))
            parts.append(materialize(made.select(F.lit(trees).alias("num_trees"), F.lit(depth).alias("max_depth"), F.col(FOLD).alias("fold"), key, label, "prediction"), "out-of-fold"))
    return reduce(DataFrame.unionAll, parts)


def fold_scores(made: DataFrame, label: str = LABEL) -> DataFrame:
    """RMSE of each fold and entry of the grid, from the stored predictions."""
    return made.groupBy("num_trees", "max_depth", "fold").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), 2))).alias("rmse"))


def averaged_scores(made: DataFrame, label: str = LABEL) -> DataFrame:
    """Mean RMSE over the folds, as ``cv_scores`` gives it."""
    return fold_scores(made, label).groupBy("num_trees", "max_depth").agg(F.avg("rmse").alias("avg_rmse"))


def predictions(model, test: DataFrame, keys=("airport_id",), features=FEATURES, label: str = LABEL) -> DataFrame:
    """Predictions table: keys, features, target and prediction (M7, M8)."""
    return model.transform(test).select(*keys, *features, label, "prediction")


def residuals(pred: DataFrame, label: str = LABEL) -> DataFrame:
    """Prediction, target and ``residual = target - prediction`` per row."""
    return pred.select("prediction", label, (F.col(label) - F.col("prediction")).alias("residual"))


def evaluate(pred: DataFrame, label: str = LABEL) -> dict[str, float]:
    """The four metrics of the reference evaluator."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {m: ev.setMetricName(m).evaluate(pred) for m in ("rmse", "mse", "mae", "r2")}


def load(path: str) -> PipelineModel:
    """A saved pipeline, for scoring in another session (K6)."""
    return PipelineModel.load(path)


def save(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline, replacing any previous one (K6)."""
    model.write().overwrite().save(path)
