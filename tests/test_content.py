import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from turnout.operators import als, ensemble


def test_content_model_is_fitted_on_kinds_of_rows(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(e % 3, e % 2, 98000 + e % 2, g, e, 5, age, e, float((p + e) % 4 == 0) + 0.1 * g_no)
         for p, (g_no, g, age) in enumerate([(0, "Male", 30), (1, "Female", None), (0, "Male", 30), (2, None, 41)] * 10)
         for e in range(6)],
        "series_id int, event_type_id int, venue_zip int, gender string, total_fee_avg int, miles_avg int, "
        "age_avg int, event_day int, y_label double")
    seen = []

    def kept(frame):
        seen.append(frame.persist())
        return frame

    monkeypatch.setattr(ensemble, "cut_lineage", kept)
    model = ensemble.content_gbt(rows, (0.1, 3, 5, 1.0))
    assert seen[0].count() == 18 and seen[0].agg(F.sum("_weight")).first()[0] == 240
    # the same trees on all rows
    every = ensemble._as_text(rows).withColumn("_weight", F.lit(1.0))
    stages = model.stages
    for stage in stages[:-1]:
        every = stage.transform(every)
    whole = GBTRegressor(featuresCol="_features", labelCol="y_label", stepSize=0.1, maxDepth=3, maxIter=5, seed=als.SEED).fit(every)
    both = stages[-1].transform(every).withColumnRenamed("prediction", "x")
    for r in whole.transform(both.drop("y")).select("x", "prediction").distinct().collect():
        assert r.x == pytest.approx(r.prediction, abs=1e-9)
