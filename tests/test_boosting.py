import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from turnout.operators import boosting, ensemble

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    a, b = F.rand(1), F.rand(2)
    found = spark.range(3_000).select("id", a.alias("a"), F.floor(b * 6).cast("double").alias("b"), F.lit(1.0).alias("c"))
    return found.withColumn("y", ((F.col("a") + F.col("b") / 10 + F.rand(3)) > 1.2).cast("int")).persist()


def by_spark(rows, variant):
    rate, depth, trees, subsample = variant
    return Pipeline(stages=[
        VectorAssembler(inputCols=COLUMNS, outputCol="_features"),
        GBTRegressor(featuresCol="_features", labelCol="_label", predictionCol="prediction", stepSize=rate, maxDepth=depth,
                     maxIter=trees, subsamplingRate=subsample, seed=20)]).fit(rows.withColumn("_label", F.col("y").cast("double")))


def test_trees_on_kinds_are_those_of_spark(spark, rows, tmp_path):
    variant = (0.1, 3, 12, 1.0)
    mine, theirs = ensemble.gbt_fit(rows, COLUMNS, "y", variant), by_spark(rows, variant)
    scored = [sorted((r.id, r.prediction) for r in ensemble.gbt_predict(m, rows).collect()) for m in (mine, theirs)]
    assert np.array(scored[0]) == pytest.approx(np.array(scored[1]), abs=1e-9)
    weights = [m.stages[-1].featureImportances.toArray() for m in (mine, theirs)]
    assert weights[0] == pytest.approx(weights[1], abs=1e-6)
    assert [m.stages[-1].totalNumNodes for m in (mine, theirs)][0] == theirs.stages[-1].totalNumNodes
    mine.stages[-1].save(str(tmp_path / "m"))
    stored = GBTRegressionModel.load(str(tmp_path / "m"))
    assert stored.toDebugString == mine.stages[-1].toDebugString and stored.getStepSize() == 0.1


def test_a_fit_takes_no_job_per_level(spark, rows):
    """Spark's own fit has a job per level and tree: the final set needed over 300."""
    from uuid import uuid4

    tag = uuid4().hex
    spark.sparkContext.setJobGroup(tag, tag)
    ensemble.gbt_fit(rows, COLUMNS, "y", (0.01, 3, 100, 0.5))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(tag)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 60


def test_drawn_rows_are_as_many_as_row_by_row(spark, rows):
    """Half of the rows a tree: root counts and errors like those of Spark's draws, other ones for each tree."""
    variant = (0.1, 3, 30, 0.5)
    mine, theirs = ensemble.gbt_fit(rows, COLUMNS, "y", variant), by_spark(rows, variant)
    kinds = boosting.kinds_of(rows, COLUMNS, "y")
    roots = boosting._grown(kinds, variant, 20).filter("nodeData.id = 0").select("nodeData.rawCount").collect()
    drawn = [r.rawCount for r in roots]
    assert len(drawn) == 30 and len(set(drawn)) > 15 and abs(np.mean(drawn) - 1_500) < 30 and 10 < np.std(drawn) < 50
    error = [ensemble.gbt_predict(m, rows).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0] for m in (mine, theirs)]
    assert error[0] == pytest.approx(error[1], rel=0.02)


def test_more_kinds_than_a_task_takes_go_to_spark(rows, monkeypatch):
    monkeypatch.setattr(boosting, "MOST_KINDS", 5)
    monkeypatch.setattr(boosting, "fit_kinds", lambda *_: pytest.fail("fitted in one task"))
    variant = (0.1, 2, 3, 1.0)
    mine, theirs = ensemble.gbt_fit(rows, COLUMNS, "y", variant), by_spark(rows, variant)
    assert mine.stages[-1].toDebugString.split("\n")[1:] == theirs.stages[-1].toDebugString.split("\n")[1:]


def test_missing_features_and_labels_are_errors(spark, rows):
    for column in ("a", "c", "y"):
        gap = rows.withColumn(column, F.when(F.col("id") != 7, F.col(column)))
        with pytest.raises(Exception, match="(?i)missing|null"):
            ensemble.gbt_fit(gap, COLUMNS, "y", (0.1, 2, 2, 1.0))


def test_cut_points_part_values_evenly():
    assert boosting.cut_points(np.array([1.0, 1.0, 3.0]), 31) == [2.0]
    assert boosting.cut_points(np.array([5.0]), 31) == []
    assert boosting.cut_points(np.arange(100.0), 3) == [24.5, 49.5, 74.5]
