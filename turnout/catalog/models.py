"""Recommenders, tuning, boosted ensembles and content model.

Scores of fitted models are not expressible in SQL. The queries return what must hold of
any right fit and can be said in SQL: which people, items, cells and settings there are,
that a person's factors are optimal for the model's items, which predictions exist, exact
ranks of the popularity list next to a rank in its range.
"""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from turnout import fixed_values as fv
from turnout.catalog import views as v
from turnout.catalog.joins import users
from turnout.catalog.registry import query, six
from turnout.operators import als, certify, ensemble, evaluate, tuning
from turnout.operators.grid import Grid, make_grid, positives_only
from turnout.operators.split import append_parts, split_grid, split_range, standard_cuts
from turnout.plans import recommendation as plan
from turnout.session import cut_lineage, scratch_path
from turnout.sources import models, tables

CUTS = standard_cuts()


def split_participations(spark, sf_dir, by: str | None = None) -> Grid:
    return split_grid(make_grid(v.participations(spark, sf_dir)), CUTS, by)


def series_model(spark, sf_dir):
    """The series recommender on all attended pairs."""
    return als.als_fit_implicit(
        positives_only(v.participations(spark, sf_dir)), "series_id", rank=5, alpha=80.0)


def fitted_series(spark, sf_dir):
    grid = split_participations(spark, sf_dir)
    return grid, als.fit_recommender(grid, "series_id", CUTS, rank=5, alpha=80.0)


# -- stored models ---------------------------------------------------------

@query("save_als_model", f"WITH {v.P} SELECT DISTINCT series_id AS item, CAST(5 AS INT) AS n_factors, TRUE AS same FROM p")
def save_als_model(spark, sf_dir):
    """Item factors read back from the stored model next to those fitted."""
    fitted = series_model(spark, sf_dir)
    stored = models.save_als_model(fitted, scratch_path(spark, "als-series"))
    before = fitted.itemFactors.select("id", F.col("features").alias("_before"))
    return stored.itemFactors.join(before, "id").select(
        F.col("id").alias("item"), F.size("features").alias("n_factors"),
        (F.col("features") == F.col("_before")).alias("same"))


@query("model_catalog", f"""WITH {v.P} SELECT DISTINCT 'series_id' AS item_col, 'person_id' AS user_col, 'drop' AS cold_start,
  'prediction' AS prediction_col, CAST(count(DISTINCT series_id) AS INT) AS rank FROM p
UNION ALL SELECT DISTINCT 'venue_zip', 'person_id', 'drop', 'prediction', CAST(count(DISTINCT venue_zip) AS INT) FROM p""")
def model_catalog(spark, sf_dir):
    """Two stored models with as many factors as their feature has values."""
    pairs = positives_only(v.participations(spark, sf_dir)).persist()
    paths = []
    for item in ("series_id", "venue_zip"):
        rank = pairs.select(item).distinct().count()
        path = scratch_path(spark, f"als-{item}")
        models.save_als_model(als.als_fit_implicit(pairs, item, rank=rank), path)
        paths.append(path)
    pairs.unpersist()
    return models.model_catalog(spark, paths).select(
        "item_col", "user_col", "cold_start", "prediction_col", "rank")


@query("export_factors", f"""WITH {v.P}, f AS (SELECT CAST(unnest(range(5)) AS INT) AS factor)
SELECT DISTINCT 'item' AS side, CAST(series_id AS BIGINT) AS id, factor, TRUE AS valid FROM p, f
UNION ALL SELECT DISTINCT 'user', person_id, factor, TRUE FROM p, f""")
def export_factors(spark, sf_dir):
    """Every factor of the exported frame; valid if not negative and, for people, part of an optimum."""
    pairs = positives_only(v.participations(spark, sf_dir))
    model = series_model(spark, sf_dir)
    optimal = certify.certified(certify.optimality(model, pairs, "series_id", alpha=80.0)).select("id", "optimal")
    factors = models.export_factors(model).select(
        "side", F.col("id").cast("long").alias("id"), F.posexplode("features").alias("factor", "loading"))
    return factors.join(optimal, "id", "left").select(
        "side", "id", "factor", ((F.col("loading") >= 0) & F.when(
            F.col("side") == "user", F.coalesce("optimal", F.lit(False))).otherwise(F.lit(True))).alias("valid"))


@query("export_factors_ids", f"""WITH {v.P}
SELECT DISTINCT 'item' AS side, CAST(series_id AS BIGINT) AS id, CAST(5 AS INT) AS n_factors, TRUE AS nonnegative FROM p
UNION ALL SELECT DISTINCT 'user', person_id, CAST(5 AS INT), TRUE FROM p""")
def export_factors_ids(spark, sf_dir):
    factors = models.export_factors(series_model(spark, sf_dir))
    return factors.select(
        "side", F.col("id").cast("long").alias("id"), F.size("features").alias("n_factors"),
        F.forall("features", lambda x: x >= 0).alias("nonnegative"))


@query("factor_exploration", f"""WITH {v.P}, n AS (SELECT least(3, count(DISTINCT series_id)) AS n FROM p)
SELECT CAST(f.i AS INT) AS factor, CAST(k.i AS INT) AS place, TRUE AS in_order
FROM (SELECT unnest(range(5)) AS i) f, (SELECT unnest(range(1, 4)) AS i) k, n WHERE k.i <= n""")
def factor_exploration(spark, sf_dir):
    """Places of the leading items per factor, and whether no later one loads more."""
    top = als.factor_exploration(series_model(spark, sf_dir))
    before = F.lag("loading").over(W.partitionBy("factor").orderBy("place"))
    return top.select("factor", "place", F.coalesce(before >= F.col("loading"), F.lit(True)).alias("in_order"))


# -- fits and predictions --------------------------------------------------

_OPTIMA = f"WITH {v.P} SELECT DISTINCT person_id AS id, CAST(100 AS INT) AS n_factors, TRUE AS optimal FROM p"


@query("als_fit_implicit", _OPTIMA)
def als_fit_implicit(spark, sf_dir):
    """People of the default fit on events (rank 100 as for the first baseline) and whether their factors are optimal."""
    pairs = positives_only(v.participations(spark, sf_dir))
    return certify.certified(certify.optimality(als.als_fit_implicit(pairs, "event_id"), pairs, "event_id"))


@query("als_fit_explicit", _OPTIMA)
def als_fit_explicit(spark, sf_dir):
    pairs = positives_only(v.participations(spark, sf_dir))
    model = als.als_fit_explicit(pairs, "event_id")
    return certify.certified(certify.optimality(model, pairs, "event_id", implicit=False))


def usable(prediction: str = "prediction"):
    """Whether a prediction is a number."""
    return F.col(prediction).isNotNull() & ~F.isnan(F.col(prediction).cast("double"))


_SERIES_KNOWN = "series_id IN (SELECT series_id FROM gs WHERE split = 'train')"


@query("als_predict", f"""WITH {v.SPLIT_G}
SELECT person_id, event_id, participated, split, TRUE AS scored FROM gs WHERE {_SERIES_KNOWN}""")
def als_predict(spark, sf_dir):
    """Cells with a known item; scored if the prediction is a number and, as of a non-negative model, not negative."""
    grid, fitted = fitted_series(spark, sf_dir)
    return als.als_predict(grid, fitted).select(
        "person_id", "event_id", "participated", "split", (usable() & (F.col("prediction") >= 0)).alias("scored"))


# items that no event of the training rows carries are cold
@query("als_predict_counts", f"""WITH {v.SPLIT_G},
kn AS (SELECT DISTINCT total_fee_avg FROM gs WHERE split = 'train')
SELECT split, count(*) FILTER (WHERE total_fee_avg IN (SELECT total_fee_avg FROM kn)) AS valid,
  count(*) FILTER (WHERE total_fee_avg NOT IN (SELECT total_fee_avg FROM kn)) AS missing FROM gs GROUP BY split""")
def als_predict_counts(spark, sf_dir):
    """Valid and cold predictions of the fee recommender."""
    grid = split_participations(spark, sf_dir)
    fitted = als.fit_recommender(grid, "total_fee_avg", CUTS, rank=5, alpha=80.0)
    return als.prediction_counts(als.als_predict(grid, fitted, drop_cold=False))


WIDE = 1 << 40


@query("als_predict_counts_wide_ids", f"""WITH {v.SPLIT_G},
kn AS (SELECT DISTINCT event_id FROM gs WHERE split = 'train')
SELECT split, count(*) FILTER (WHERE event_id IN (SELECT event_id FROM kn)) AS valid,
  count(*) FILTER (WHERE event_id NOT IN (SELECT event_id FROM kn)) AS missing,
  count(DISTINCT person_id) AS people, max(person_id) + {WIDE} AS largest_id FROM gs GROUP BY split""")
def als_predict_counts_wide_ids(spark, sf_dir):
    """Valid and cold predictions of the event recommender where no id fits 32 bits."""
    parts = v.participations(spark, sf_dir).withColumns(
        {c: F.col(c) + F.lit(WIDE) for c in ("person_id", "event_id")})
    grid = split_grid(make_grid(parts), CUTS)
    fitted = als.fit_recommender(grid, "event_id", CUTS, rank=5, alpha=80.0)
    scored = als.als_predict(grid, fitted, drop_cold=False)
    counts = als.prediction_counts(scored)
    people = scored.groupBy("split").agg(F.count_distinct("person_id").alias("people"), F.max("person_id").alias("largest_id"))
    return counts.join(people, "split")


def popularity_sql(cells: str, item: str) -> str:
    """``rank_bar`` of recommending the most attended items of some cells to everybody."""
    return f"""(SELECT round(sum(att * rank_ui) / sum(att), 6) FROM (
  SELECT att, (row_number() OVER (ORDER BY att DESC, {item}) - 1) * 100.0 / count(*) OVER () AS rank_ui
  FROM (SELECT {item}, sum(participated) AS att FROM {cells} GROUP BY 1 HAVING sum(participated) > 0)))"""


def in_range(rank: str):
    """Whether a rank is between the top and the bottom of a list."""
    return F.col(rank).between(0, 100)


def next_to(scores, exact, popular: str):
    """``scores`` with the exact rank of the popularity list in place of ``popular``, and whether the two agree.

    They do if they are equal or, as the rule is where a model scores nothing above 0, it says 100.
    """
    said = scores.join(F.broadcast(exact.withColumnRenamed("popularity_mean", "_exact")))
    agrees = (F.abs(F.col(popular) - F.col("_exact")) < 1e-6) | (F.col(popular) == 100)
    return said.withColumns({"agrees": agrees, popular: six("_exact")}).drop("_exact")


def attended_of(grid, split, item, cuts=CUTS, first="train", trained_on="train"):
    """Attended cells of a split whose item the training rows have."""
    low, high = split_range(cuts, trained_on, first)
    known = grid.events.filter(low < high).select(item).distinct()
    return als.attended_cells(grid, cuts, first).filter(F.col("split") == split).join(known, item)


@query("als_rank", f"""WITH {v.SPLIT_G}, t AS (SELECT * FROM gs WHERE split = 'test' AND {_SERIES_KNOWN})
SELECT {popularity_sql('t', 'series_id')} AS popularity_rank_bar, TRUE AS ranked, TRUE AS agrees""")
def als_rank(spark, sf_dir):
    grid, fitted = fitted_series(spark, sf_dir)
    exact = evaluate.popularity_mean(attended_of(grid, "test", "series_id"), "series_id")
    return next_to(als.rank_scores(grid, fitted, "test"), exact, "popularity_rank_bar").select(
        "popularity_rank_bar", in_range("rank_bar").alias("ranked"), "agrees")


# cells before and after the test cut of each series, and the former cut by date
BY_SERIES = v.G + """,
bs AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY event_date, event_id, person_id) AS pos,
  count(*) OVER (PARTITION BY series_id) AS n FROM g),
bt AS (SELECT *, CASE WHEN pos > round(n*0.8) THEN 'test' ELSE 'trainval' END AS split FROM bs),
bo AS (SELECT *, row_number() OVER (ORDER BY event_date, event_id, person_id) AS pos2, count(*) OVER () AS n2
  FROM bt WHERE split = 'trainval'),
bv AS (SELECT * FROM bo WHERE pos2 > round(n2*0.8))"""


def five_scored(spark, sf_dir):
    """The five recommenders with their final parameters, predictions side by side."""
    grid = split_grid(make_grid(v.participations(spark, sf_dir)), plan.TEST_CUT, "series_id")
    fitted = als.fit_five(grid, plan.TEST_CUT, "trainval", "trainval")
    return als.score_cells(grid, fitted, plan.TEST_CUT, "trainval").select(
        "person_id", "event_id", "participated", "event_date", "split", *fitted)


_KNOWN = ", ".join(f"{item} IN (SELECT {item} FROM bt WHERE split = 'trainval') AS {item}_known"
                   for item in fv.RECOMMENDER_RANKS)


@query("als_multi_feature", f"WITH {BY_SERIES} SELECT person_id, event_id, participated, split, {_KNOWN} FROM bt")
def als_multi_feature(spark, sf_dir):
    """Cells with, per recommender, whether it gives a score: it does for items of its training rows."""
    return five_scored(spark, sf_dir).select(
        "person_id", "event_id", "participated", "split",
        *[(usable(f"{item}_prediction") & (F.col(f"{item}_prediction") >= 0)).alias(f"{item}_known")
          for item in fv.RECOMMENDER_RANKS])


def _ledger_sql(item: str, factors: int, split: str) -> str:
    known = f"{item} IN (SELECT {item} FROM bt WHERE split = 'trainval')"
    cells = f"(SELECT * FROM bt WHERE split = '{split}' AND {known}) t"
    return f"""SELECT '{item}' AS als_model, '{split}' AS split, CAST({fv.RECOMMENDER_ALPHA} AS DOUBLE) AS alpha,
  CAST({factors} AS INT) AS factors, {popularity_sql(cells, item)} AS popular_rank,
  (SELECT count(*) FROM bt WHERE split = '{split}' AND NOT ({known})) AS cold_starts_dropped, TRUE AS ranked, TRUE AS agrees"""


@query("final_ledger", f"WITH {BY_SERIES} " + " UNION ALL ".join(
    _ledger_sql(item, factors, split) for item, factors in fv.RECOMMENDER_RANKS.items() for split in ("trainval", "test")))
def final_ledger(spark, sf_dir):
    """The five final models on both splits: popularity rank and cold cells are exact."""
    grid = split_grid(make_grid(v.participations(spark, sf_dir)), plan.TEST_CUT, "series_id")
    ledger = plan.final_ledger(grid, als.fit_five(grid, plan.TEST_CUT, "trainval", "trainval"))
    parts = [next_to(ledger.filter((F.col("als_model") == item) & (F.col("split") == split)), evaluate.popularity_mean(
        attended_of(grid, split, item, plan.TEST_CUT, "trainval", "trainval"), item), "popular_rank")
        for item in fv.RECOMMENDER_RANKS for split in ("trainval", "test")]
    return append_parts(parts).select("als_model", "split", "alpha", "factors", "popular_rank", "cold_starts_dropped",
                                      in_range("model_rank").alias("ranked"), "agrees")


@query("naive_ranks", f"""WITH {BY_SERIES}
SELECT 'naive_' || kind AS gb_model, split, popular_rank, TRUE AS ranked, TRUE AS agrees FROM (VALUES ('mean'), ('smallest'), ('largest')) AS t(kind), (
  SELECT 'trainval' AS split, {popularity_sql("(SELECT * FROM bt WHERE split = 'trainval') t", 'event_id')} AS popular_rank
  UNION ALL SELECT 'test', {popularity_sql("(SELECT * FROM bt WHERE split = 'test') t", 'event_id')})""")
def naive_ranks(spark, sf_dir):
    """Plain ensembles of the five recommenders next to the popularity list."""
    cells = scored_cells(spark, sf_dir)
    ledger = plan.naive_ranks(cells)
    parts = [next_to(ledger.filter(F.col("split") == part), evaluate.popularity_mean(
        cells.filter(F.col("split") == part), "event_id"), "popular_rank") for part in ("trainval", "test")]
    return append_parts(parts).select("gb_model", "split", "popular_rank", in_range("model_rank").alias("ranked"), "agrees")


# -- tuning ----------------------------------------------------------------

def _rows(name: str, values) -> str:
    return f"(VALUES {', '.join(f'({x})' for x in values)}) AS {name}_t({name})"


@query("grid_search_rank", f"""WITH {v.SPLIT_G}, t AS (SELECT * FROM gs WHERE split = 'validate' AND {_SERIES_KNOWN})
SELECT 'series_id' AS als_model, CAST(alpha AS DOUBLE) AS alpha, CAST(factors AS INT) AS factors,
  {popularity_sql('t', 'series_id')} AS popular_rank, TRUE AS ranked, TRUE AS agrees
FROM {_rows('alpha', fv.SEARCH_ALPHAS)}, {_rows('factors', fv.SEARCH_RANKS)}""")
def grid_search_rank(spark, sf_dir):
    grid = split_participations(spark, sf_dir)
    exact = evaluate.popularity_mean(attended_of(grid, "validate", "series_id"), "series_id")
    return next_to(tuning.grid_search_rank(grid, "series_id", CUTS), exact, "popular_rank").select(
        "als_model", "alpha", F.col("factors").cast("int").alias("factors"), "popular_rank",
        in_range("model_rank").alias("ranked"), "agrees")


_SPACE = f"""SELECT CAST(rank AS INT) AS rank, CAST(max_iter AS INT) AS max_iter, CAST(reg_param AS DOUBLE) AS reg_param,
  CAST(alpha AS DOUBLE) AS alpha, TRUE AS scored
FROM {_rows('rank', tuning.SPACE['rank'])}, {_rows('max_iter', tuning.SPACE['max_iter'])},
  {_rows('reg_param', tuning.SPACE['reg'])}, {_rows('alpha', tuning.SPACE['alpha'])}"""


def _scored_settings(trace):
    """Settings, and whether each has a metric that is a number."""
    return trace.select("rank", "max_iter", "reg_param", "alpha", (usable("metric") & (F.col("metric") >= 0)).alias("scored"))


@query("als_cross_validate", _SPACE)
def als_cross_validate(spark, sf_dir):
    """All 36 settings, three folds, error over all cells of the training split."""
    return _scored_settings(tuning.tune_recommender(
        split_participations(spark, sf_dir), "series_id", CUTS, folds=3))


@query("als_train_validation", _SPACE)
def als_train_validation(spark, sf_dir):
    """All 36 settings, one fold of four held, error over its attended cells."""
    return _scored_settings(tuning.tune_recommender(
        split_participations(spark, sf_dir), "series_id", CUTS, folds=4, held=(0,), score=tuning.rmse_of_attended))


@query("tuning_trace", _SPACE)
def tuning_trace(spark, sf_dir):
    """All 36 settings, one fold of four held, rank over all its cells."""
    return _scored_settings(tuning.tune_recommender(
        split_participations(spark, sf_dir), "series_id", CUTS, folds=4, held=(0,), score=tuning.rank_of_all))


# -- boosted ensembles -----------------------------------------------------

def scored_cells(spark, sf_dir):
    """Stored predictions of the five recommenders."""
    return tables.snapshot(five_scored(spark, sf_dir), scratch_path(spark, "cells"))


def trainval(spark, sf_dir):
    return ensemble.fill_prediction_mean(
        scored_cells(spark, sf_dir).filter("split = 'trainval'").drop("split"))


@query("gbt_fit", f"WITH {BY_SERIES} SELECT person_id, event_id, participated, TRUE AS scored FROM bt WHERE split = 'trainval'")
def gbt_fit(spark, sf_dir):
    """Final boosted ensemble: the rows it was trained on, and whether it scores them."""
    rows = trainval(spark, sf_dir)
    return ensemble.gbt_predict(ensemble.gbt_fit(rows), rows).select(
        "person_id", "event_id", "participated", usable().alias("scored"))


@query("gbt_predict_rank", f"""WITH {BY_SERIES},
a AS (SELECT * FROM bt WHERE split = 'trainval'), b AS (SELECT * FROM bt WHERE split = 'test')
SELECT 'trainval' AS split, {popularity_sql('a', 'event_id')} AS popularity_rank_bar, TRUE AS ranked, TRUE AS agrees
UNION ALL SELECT 'test', {popularity_sql('b', 'event_id')}, TRUE, TRUE""")
def gbt_predict_rank(spark, sf_dir):
    run = plan.run_ensemble(v.participations(spark, sf_dir), scratch_path(spark, "ensemble"))
    scores = []
    for part in ("trainval", "test"):
        rows = ensemble.fill_prediction_mean(run.scored.filter(F.col("split") == part))
        scores.append(next_to(ensemble.gbt_predict_rank(run.model, rows).withColumn("split", F.lit(part)),
                              evaluate.popularity_mean(rows, "event_id"), "popularity_rank_bar"))
    return append_parts(scores).select("split", "popularity_rank_bar", in_range("rank_bar").alias("ranked"), "agrees")


@query("feature_importance", " UNION ALL ".join(
    f"SELECT '{item}_prediction' AS feature, TRUE AS is_share, 1.0::DOUBLE AS total" for item in fv.RECOMMENDER_RANKS))
def feature_importance(spark, sf_dir):
    """Importances of the final variant: shares of one."""
    found = ensemble.feature_importance(ensemble.gbt_fit(trainval(spark, sf_dir)))
    return found.select("feature", F.col("importance").between(0, 1).alias("is_share"),
                        F.round(F.sum("importance").over(W.partitionBy()), 6).alias("total"))


_VARIANTS = ", ".join(f"('{name}', {float(rate)}, {float(depth)}, {float(trees)}, {float(subsample)})"
                      for name, (rate, depth, trees, subsample) in fv.BOOSTING_VARIANTS.items())


@query("gbt_variants", f"""WITH {BY_SERIES}
SELECT gb_model, 'val' AS split, CAST(rate AS DOUBLE) AS learning_rate, CAST(depth AS DOUBLE) AS max_depth,
  CAST(trees AS DOUBLE) AS n_est, CAST(subsample AS DOUBLE) AS subsample,
  {popularity_sql('bv', 'event_id')} AS popular_rank, TRUE AS ranked, TRUE AS agrees, 1 AS n_chosen
FROM (VALUES {_VARIANTS}) AS t(gb_model, rate, depth, trees, subsample)""")
def gbt_variants(spark, sf_dir):
    """Ledger of all eight parameter sets, with all their trees."""
    train, validate = plan.train_validate(scored_cells(spark, sf_dir))
    paths = [tables.snapshot(rows, scratch_path(spark, "boosting")) for rows in (train, validate)]
    ledger = ensemble.compare_variants(*paths)
    chosen = (F.col("gb_model") == ensemble.best_variant(ledger)).cast("int")
    exact = evaluate.popularity_mean(paths[1], "event_id")
    return next_to(ledger, exact, "popular_rank").select(
        "gb_model", "split", "learning_rate", "max_depth", "n_est", "subsample", "popular_rank",
        in_range("model_rank").alias("ranked"), "agrees",
        F.sum(chosen).over(W.partitionBy()).cast("int").alias("n_chosen"))


@query("content_gbt", f"""WITH {v.SPLIT_G}
SELECT person_id, event_id, CAST(participated AS DOUBLE) AS y_label, TRUE AS scored FROM gs
WHERE split = 'validate' AND {_SERIES_KNOWN}""")
def content_gbt(spark, sf_dir):
    """Content model with hybrid labels: rows of the validation split, and whether it scores them."""
    grid, fitted = fitted_series(spark, sf_dir)
    people = cut_lineage(users(spark, sf_dir))
    cells = als.als_predict(grid, fitted)
    train = cells.filter("split = 'train'")
    model = ensemble.content_gbt(
        ensemble.content_rows(train, people, None, True))
    validate = ensemble.content_rows(cells.filter("split = 'validate'").drop("prediction"), people)
    return ensemble.content_predict(model, validate).select(
        "person_id", "event_id", "y_label", usable().alias("scored"))
