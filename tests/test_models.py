import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tests.test_grid_split import participations
from turnout.operators import als, ensemble, tuning
from turnout.operators.evaluate import RankBarEvaluator, popularity_rank_bar, rank_bar
from turnout.operators.grid import als_matrix, make_grid, participation_grid, positives_only
from turnout.operators.recommend import (
    audience_age, audience_gender_share, audience_profile, top_event_counts, top_k_per_person)
from turnout.operators.split import split_cells, split_grid, standard_cuts
from turnout.plans.recommendation import ensemble_top_lists, recommend_events, run_ensemble, train_validate
from turnout.sources.models import export_factors, model_catalog, save_als_model

CUTS = standard_cuts()


@pytest.fixture(scope="module")
def fitted(spark):
    grid = split_grid(make_grid(participations(spark, people=60, events=20)), CUTS)
    return grid, als.fit_recommender(grid, "venue_zip", CUTS, rank=4, alpha=40.0, max_iter=5)


def test_positives_are_the_attended_cells(spark):
    parts = participations(spark, repeat=0.4)
    cells = participation_grid(parts).filter("participated = 1")
    assert sorted(map(tuple, positives_only(parts).collect())) == sorted(map(tuple, cells.collect()))
    assert als_matrix(cells, "series_id").columns == ["person_id", "series_id", "participated", "event_date"]


def test_predictions_equal_the_model_transform(fitted):
    grid, model = fitted
    mine = {(r.person_id, r.event_id): r.prediction for r in als.als_predict(grid, model).collect()}
    theirs = model.model.transform(grid.cells().withColumn("person_id", F.col("person_id").cast("int")))
    rows = theirs.collect()
    assert rows and all(abs(mine[r.person_id, r.event_id] - r.prediction) < 1e-5 for r in rows)
    # people without an attended training cell are scored 0, not dropped
    known = {r.id for r in model.model.userFactors.collect()}
    rest = [v for (p, _), v in mine.items() if p not in known]
    assert all(v == 0 for v in rest)


def test_dense_training_gives_the_same_scores(spark, fitted):
    grid, model = fitted
    train = split_cells(make_grid(participations(spark, people=60, events=20)), CUTS).filter("split = 'train'")
    dense = ALS(rank=4, maxIter=5, regParam=0.1, alpha=40.0, userCol="person_id", itemCol="venue_zip",
                ratingCol="participated", implicitPrefs=True, nonnegative=True, seed=als.SEED,
                numUserBlocks=8, numItemBlocks=8, coldStartStrategy="drop")
    scores = dense.fit(train.withColumn("person_id", F.col("person_id").cast("int"))).transform(
        train.withColumn("person_id", F.col("person_id").cast("int")))
    mine = {(r.person_id, r.event_id): r.prediction
            for r in als.als_predict(grid, model).filter("split = 'train'").collect()}
    rows = scores.collect()
    assert len(rows) == len(mine)
    # starting factors differ when zero-only people are laid out too, hence a tolerance
    gaps = sorted(abs(mine[r.person_id, r.event_id] - r.prediction) for r in rows)
    assert gaps[len(gaps) // 2] < 0.05


def test_item_level_ranks_equal_grid_ranks(fitted):
    grid, model = fitted
    cells = als.als_predict(grid, model)
    for split in ("train", "validate", "test"):
        found = als.rank_scores(grid, model, split).first()
        rows = cells.filter(F.col("split") == split)
        assert found.rank_bar == pytest.approx(rank_bar(rows).first()[0], abs=1e-6)
        assert found.popularity_rank_bar == pytest.approx(popularity_rank_bar(rows, "venue_zip").first()[0])


def test_factors_catalog_and_repeatability(spark, fitted, tmp_path):
    grid, model = fitted
    assert export_factors(model.model).filter(F.exists("features", lambda x: x < 0)).count() == 0
    path = str(tmp_path / "venue")
    stored = save_als_model(model.model, path)
    assert stored.itemFactors.count() == model.model.itemFactors.count()
    row = model_catalog(spark, [path]).first()
    assert (row.item_col, row.user_col, row.cold_start, row.rank) == ("venue_zip", "person_id", "drop", 4)
    again = als.fit_recommender(grid, "venue_zip", CUTS, rank=4, alpha=40.0, max_iter=5)
    a = {r.id: r.features for r in model.model.itemFactors.collect()}
    b = {r.id: r.features for r in again.model.itemFactors.collect()}
    assert a == b
    assert als.factor_exploration(model.model, top=2).count() == 8


def test_cold_items_are_counted_and_dropped(fitted):
    grid, model = fitted
    all_rows = als.als_predict(grid, model, drop_cold=False)
    counts = all_rows.groupBy().agg(F.count_if(F.col("prediction").isNull())).first()[0]
    assert als.als_predict(grid, model).count() == all_rows.count() - counts
    total = als.prediction_counts(all_rows).agg(F.sum("missing")).first()[0]
    assert total == counts


def test_tuning(spark, fitted):
    grid, _ = fitted
    ledger = tuning.grid_search_rank(grid, "series_id", CUTS, alphas=[10.0, 80.0], ranks=[3]).collect()
    assert [r.model_rank for r in ledger] == sorted(r.model_rank for r in ledger) and len(ledger) == 2
    space = {"ranks": (3,), "max_iters": (2,), "regs": (0.1,), "alphas": (1.0, 20.0)}
    cells = split_cells(make_grid(participations(spark)), CUTS).filter("split = 'train'").persist()
    for model in (tuning.als_train_validation(cells, "series_id", scoring=RankBarEvaluator(), **space),
                  tuning.als_cross_validate(cells, "series_id", folds=2, **space)):
        trace = tuning.tuning_trace(model).collect()
        assert len(trace) == 2 and all(r.metric >= 0 for r in trace)
    assert tuning.score_with(model, cells, "series_id") >= 0
    cells.unpersist()


def test_ensemble_run(spark, tmp_path):
    parts = participations(spark, people=60, events=20)
    run = run_ensemble(parts, str(tmp_path), variant=(0.1, 2, 3, 1.0))
    assert run.scored.count() == 60 * run.grid.n_events
    top = ensemble_top_lists(run, 2)
    assert top.groupBy("person_id").count().filter("count > 2").count() == 0
    train, validate = train_validate(run.scored)
    ledger, best, model = ensemble.gbt_variants(
        train, validate, {"a": (0.1, 2, 2, 1.0), "b": (0.01, 2, 2, 0.5)})
    scores = {r.gb_model: r.model_rank for r in ledger.collect()}
    assert scores[best] == min(scores.values())
    weights = [r.importance for r in ensemble.feature_importance(model).collect()]
    assert sum(weights) == pytest.approx(1) and len(weights) == 5


def test_content_model_takes_unseen_values(spark, fitted):
    grid, model = fitted
    cells = als.als_predict(grid, model)
    users = grid.ids.select("person_id", F.lit("Male").alias("gender"), F.lit(30).alias("age_avg"))
    train = cells.filter("split = 'train'")
    rows = ensemble.content_rows(train.drop("prediction"), users, train)
    fitted_trees = ensemble.content_gbt(rows, (0.1, 2, 2, 1.0))
    later = cells.filter("split = 'test'").drop("prediction").withColumn("venue_zip", F.lit(1))
    scored = ensemble.content_predict(fitted_trees, ensemble.content_rows(later, users))
    assert scored.count() == later.count() and scored.filter("prediction IS NULL").count() == 0


def test_flagship_and_audience(spark):
    parts = participations(spark, people=60, events=20)
    counts = recommend_events(parts, k=2)
    assert counts.columns == ["event_id", "top_count"] and counts.count() > 0
    cells = participation_grid(parts).withColumn("prediction", F.col("event_id") / 100)
    top = top_k_per_person(cells, 1)
    assert [(r.event_id, r.top_count) for r in top_event_counts(top).collect()] == [(19, 60)]
    people = parts.select("person_id").distinct().withColumns(
        {"gender": F.when(F.col("person_id") % 2 == 0, "Male").otherwise("Other"), "age": F.lit(40)})
    audience = audience_profile(top, people)
    share = audience_gender_share(audience, people).first()
    assert share.male_share == 0.5 and share.population_male_share == 1.0
    assert audience_age(audience, people).first().audience_age == 40


def test_registered_fits_have_their_whole_parameters(monkeypatch):
    import inspect

    from turnout.catalog import models as catalog

    used = {}

    def caught(name, function):
        def stub(*args, **kwargs):
            bound = inspect.signature(function).bind(*args, **kwargs)
            bound.apply_defaults()
            used[name] = bound.arguments["variant"]
            raise InterruptedError
        return stub

    monkeypatch.setattr(catalog, "trainval", lambda *_: None)
    monkeypatch.setattr(catalog.ensemble, "gbt_fit", caught("importance", catalog.ensemble.gbt_fit))
    with pytest.raises(InterruptedError):
        catalog.feature_importance(None, "")
    monkeypatch.setattr(catalog, "fitted_series", lambda *_: (None, None))
    monkeypatch.setattr(catalog, "users", lambda *_: None)
    monkeypatch.setattr(catalog, "cut_lineage", lambda x: x)
    frame = type("Frame", (), {"filter": lambda self, _: self, "drop": lambda self, _: self})()
    monkeypatch.setattr(catalog.als, "als_predict", lambda *_: frame)
    monkeypatch.setattr(catalog.ensemble, "content_rows", lambda *_: None)
    monkeypatch.setattr(catalog.ensemble, "content_gbt", caught("content", catalog.ensemble.content_gbt))
    with pytest.raises(InterruptedError):
        catalog.content_gbt(None, "")
    assert used == {"importance": (0.01, 3, 100, 0.5), "content": (0.1, 3, 100, 1.0)}
