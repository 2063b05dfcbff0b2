import pytest
from pyspark.sql import functions as F

from turnout.operators.evaluate import rank_detail


def test_all_parameter_sets_are_compared(spark, monkeypatch):
    from turnout import fixed_values as fv
    from turnout.catalog import SQL, models as catalog

    used = []

    def caught(train, validate, variants=fv.BOOSTING_VARIANTS, *_):
        used.extend(variants)
        raise InterruptedError

    monkeypatch.setattr(catalog, "scored_cells", lambda *_: None)
    monkeypatch.setattr(catalog.plan, "train_validate", lambda _: (None, None))
    monkeypatch.setattr(catalog, "scratch_path", lambda *_: "")
    monkeypatch.setattr(catalog.tables, "snapshot", lambda *_: None)
    monkeypatch.setattr(catalog.ensemble, "compare_variants", caught)
    with pytest.raises(InterruptedError):
        catalog.gbt_variants(spark, "")
    assert used == ["base", "v2", "v3", "v4", "v5", "v6", "v7", "v8"]
    assert all(f"('{name}', " in SQL["gbt_variants"] for name in used)


def test_equal_scores_rank_at_the_top_not_above(spark):
    score = 0.16907559614486659
    cells = spark.range(60).select(F.lit(1).alias("person_id"), (F.col("id") < 18).cast("int").alias("participated"),
                                   F.lit(score).alias("prediction"))
    assert rank_detail(cells).first().weighted_rank >= 0
    many = spark.range(60_000).select((F.col("id") % 2_000).alias("person_id"), F.lit(1).alias("participated"),
                                      (F.col("id") % 2_000 / 7_001 + 0.1).alias("prediction"))
    assert rank_detail(many).filter("weighted_rank < 0").count() == 0
