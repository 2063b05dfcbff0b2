from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_grid_split import participations
from turnout.operators import als, certify, few_items, tuning
from turnout.operators.grid import make_grid
from turnout.operators.split import split_grid, standard_cuts

CUTS = standard_cuts()
ITEM = "venue_zip"


@pytest.mark.parametrize("alpha, reg", [(0.01, 0.1), (1.0, 0.01), (20.0, 0.01)])
def test_people_are_at_the_optimum(alpha, reg):
    pick = np.random.default_rng(1)
    rows = pick.integers(0, 9, (300, 5)) * (pick.random((300, 5)) < 0.6)
    for rank in (1, 3, 40):
        fit = few_items.Fit(0, alpha, reg, pick.random((5, rank)) * (pick.random((5, rank)) < 0.7))
        scores, factors = few_items.people_step(rows, fit)
        assert np.allclose(scores, factors @ fit.items.T, atol=1e-9) and (factors >= 0).all()
        assert not factors[rows.sum(axis=1) == 0].any()
        gradient = ((1 + alpha * rows) * scores - (1 + alpha) * rows) @ fit.items + reg * rows.sum(axis=1)[:, None] * factors
        assert gradient.min() > -1e-7 and np.abs(gradient[factors > 0]).max(initial=0) < 1e-7
        # an item's side, by its own equations
        a, b = fit.items.T @ fit.items + reg * np.eye(rank), pick.standard_normal(rank)
        x = few_items.nonnegative(a, b)
        assert (x >= 0).all() and (a @ x - b).min() > -1e-9 and np.abs((a @ x - b)[x > 0]).max(initial=0) < 1e-9


def as_model(spark, sums, items, fold, fit):
    """Factors of everybody, as Spark's model has them."""
    people = sums.attended.filter(F.col("fold") != fold).groupBy("person_id").agg(F.collect_list(ITEM).alias("i")).collect()
    rows = np.array([[list(p.i).count(i) for i in items] for p in people])
    users = few_items.people_step(rows, fit)[1]
    known = [(i, y.tolist()) for i, y in zip(items, fit.items) if y.any()]
    return SimpleNamespace(
        rank=fit.items.shape[1], itemFactors=spark.createDataFrame(known, "id int, features array<double>"),
        userFactors=spark.createDataFrame([(p.person_id, x.tolist()) for p, x in zip(people, users)],
                                          "id long, features array<double>"))


@pytest.mark.parametrize("by", [None, "series_id"])
def test_shared_scores_equal_those_of_single_models(spark, by):
    grid = split_grid(make_grid(participations(spark, people=61, events=20)), CUTS, by)
    sums = tuning.fold_sums(grid, ITEM, CUTS, "train", als.Folds(3))
    items = tuning.few_of(sums)
    settings = [{"rank": 4, "max_iter": i, "reg": 0.1, "alpha": a} for i in (2, 3) for a in (1.0, 20.0)]
    cases = few_items.stored_cases(tuning.person_cases(sums, items, (0, 1, 2)))
    kinds = cases.groupBy("fold", "rows").agg(F.sum("people").alias("people"))
    fits = few_items.all_fits(kinds, len(items), settings, (0, 1, 2), 20)
    assert len(fits) == 12
    found = {score: tuning.shared_scores(sums, items, settings, (0, 1, 2), score, 20) for score in tuning.SHARED_SCORES}
    for i, fold in ((0, 0), (3, 1), (1, 2)):
        model = as_model(spark, sums, items, fold, fits[i, fold])
        fitted = als.Recommender(model, ITEM, CUTS)
        for score, values in found.items():
            assert values[i, fold] == pytest.approx(score(sums, fitted, fold), rel=1e-6)
        conditions = certify.optimality(model, sums.attended.filter(F.col("fold") != fold), ITEM,
                                        alpha=settings[i]["alpha"])
        assert conditions.filter("nonnegative AND residual < 1e-9").count() == model.userFactors.count()
    # a shorter fit is the longer one on its way
    short = few_items.all_fits(kinds, len(items), settings[:2], (0,), 20)
    assert np.allclose(short[1, 0].items, fits[1, 0].items)
    sums.attended.unpersist()


def test_a_step_is_that_of_spark(spark):
    """Spark's model, taken as a start, and one step of its equations from it."""
    grid = split_grid(make_grid(participations(spark, people=61, events=20)), CUTS)
    sums = tuning.fold_sums(grid, ITEM, CUTS, "train", als.Folds(3))
    items, rows = tuning.few_of(sums), sums.attended.filter("fold <> 1")
    model = als.als_fit_implicit(rows, ITEM, rank=3, max_iter=200, reg=0.1, alpha=5.0)
    factors = {r.id: r.features for r in model.itemFactors.collect()}
    fit = few_items.Fit(1, 5.0, 0.1, np.array([factors[i] for i in items]))
    kinds = tuning.person_cases(sums, items, (1,)).groupBy("fold", "rows").agg(F.count("held").alias("people"))
    # after many steps a further one changes nothing
    assert np.allclose(few_items.one_step(kinds, [fit])[0].items, fit.items, atol=5e-3)
    sums.attended.unpersist()


def test_tuning_with_few_items_needs_no_fit_of_its_own(spark, monkeypatch):
    grid = split_grid(make_grid(participations(spark)), CUTS)
    monkeypatch.setattr(tuning, "als_fit_implicit", lambda *_, **__: pytest.fail("a fit for one setting"))
    space = {"rank": (2, 3), "max_iter": (1, 2), "reg": (0.1,), "alpha": (1.0, 20.0)}
    trace = tuning.tune_recommender(grid, "series_id", CUTS, space=space).collect()
    assert len(trace) == 8 and all(r.metric >= 0 for r in trace)
