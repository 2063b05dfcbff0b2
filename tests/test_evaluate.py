import random

import pytest
from pyspark.sql import functions as F

from turnout.operators import evaluate as ev
from turnout.operators import ensemble
from turnout.operators.profile import frame_diff, size_histogram
from turnout.operators.recommend import top_k_per_person

SCORED = "person_id long, event_id long, participated int, prediction double"


def brute_rank_bar(rows):
    """The definition, person by person and row by row."""
    if max(r[3] for r in rows) == 0:
        return 100.0
    top = bottom = 0.0
    for person in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == person]
        best = max(r[3] for r in own)
        top += sum(r[2] * ((1 - r[3] / best) * 100 if best > 0 else 0) for r in own)
        bottom += sum(r[2] for r in own)
    return top / bottom


def scored_rows(seed=1, people=40, events=15):
    pick = random.Random(seed)
    return [(p, e, int(pick.random() < 0.3), 0.0 if p == 3 else round(pick.random(), 3))
            for p in range(people) for e in range(events)]


def test_rank_bar_is_the_definition(spark):
    rows = scored_rows()
    df = spark.createDataFrame(rows, SCORED)
    assert ev.rank_bar(df).first()[0] == pytest.approx(brute_rank_bar(rows))
    assert ev.RankBarEvaluator().evaluate(df) == pytest.approx(brute_rank_bar(rows))
    assert not ev.RankBarEvaluator().isLargerBetter()
    zero = ev.rank_detail(df).filter("person_id = 3").first()
    assert zero.weighted_rank == 0 and zero.n_rows == 15
    ranked = ev.user_rank_ui(df)
    total = ranked.agg(F.sum(F.col("participated") * F.col("rank_ui")) / F.sum("participated")).first()[0]
    assert total == pytest.approx(brute_rank_bar(rows))


def test_rank_bar_extremes(spark):
    perfect = [(p, e, int(e < 3), 1.0 if e < 3 else 0.2) for p in range(5) for e in range(9)]
    assert ev.rank_bar(spark.createDataFrame(perfect, SCORED)).first()[0] == 0
    nothing = spark.createDataFrame([(1, 1, 1, 0.0), (2, 1, 0, 0.0)], SCORED)
    assert ev.rank_bar(nothing).first()[0] == 100
    assert ev.popularity_rank_bar(nothing, "event_id").first()[0] == 100
    pick = random.Random(9)
    noise = [(p, e, int(pick.random() < 0.5), pick.random()) for p in range(300) for e in range(40)]
    assert 45 < ev.rank_bar(spark.createDataFrame(noise, SCORED)).first()[0] < 55


def test_popularity_ties_and_items_never_attended(spark):
    rows = [(1, 5, 1, .1), (2, 5, 1, .1), (1, 7, 1, .2), (2, 6, 1, .2), (1, 9, 0, .9)]
    df = spark.createDataFrame(rows, SCORED)
    found = [(r.event_id, r.attendance, r.rank_ui) for r in ev.popularity_rank(df, "event_id").orderBy("rank_ui").collect()]
    assert found == [(5, 2, 0.0), (6, 1, pytest.approx(100 / 3)), (7, 1, pytest.approx(200 / 3))]
    assert ev.popularity_rank_bar(df, "event_id").first()[0] == pytest.approx(100 / 4)


def test_regression_metrics_match_spark_ml(spark):
    rows = [(p, e, a, None if e == 4 else s) for p, e, a, s in scored_rows(4)]
    df = spark.createDataFrame(rows, SCORED)
    found = ev.regression_metrics(df).first()
    for metric in ("rmse", "mse", "r2", "mae"):
        assert found[metric] == pytest.approx(ev.ml_metric(df, metric))


def test_top_k_keeps_min_of_k_and_n(spark):
    rows = scored_rows(2, 10, 4) + [(99, 1, 0, 0.5), (99, 0, 0, 0.5)]
    top = top_k_per_person(spark.createDataFrame(rows, SCORED), 3).collect()
    sizes = {p: sum(t.person_id == p for t in top) for p in {t.person_id for t in top}}
    assert sizes == {**{p: 3 for p in range(10)}, 99: 2}
    assert [t.event_id for t in sorted(top, key=lambda t: t.place) if t.person_id == 99] == [0, 1]


def test_ensembles_and_merges(spark):
    df = spark.createDataFrame([(1, 0.5, 0.1, 0.9), (2, None, 0.2, 0.4)], "i int, a double, b double, c double")
    low = {r.i: r.prediction for r in ensemble.extreme_ensemble(df, ["a", "b", "c"]).collect()}
    assert low == {1: pytest.approx(0.3), 2: pytest.approx(0.3)}
    assert ensemble.mean_ensemble(df, ["a", "b", "c"]).filter("i = 1").first().prediction == pytest.approx(0.5)
    filled = ensemble.fill_prediction_mean(df, ["a"]).filter("i = 2").first()
    assert filled.a == 0.5
    # two same-day events with one feature value: the feature key multiplies rows, the default does not
    data = spark.createDataFrame([(1, 10, 0, "d", 3), (1, 11, 0, "d", 3)],
                                 "person_id long, event_id long, participated int, event_date string, series_id int")
    preds = data.withColumn("prediction", F.lit(0.5))
    assert ensemble.merge_predictions(data, preds, "series_id").count() == 2
    assert ensemble.merge_predictions(data, preds, "series_id", on_feature=True).count() == 4
    coded = ensemble.dummy_columns(data, ["series_id"])
    assert ensemble.align_columns(coded, ["event_id", "series_id_9"]).first().series_id_9 == 0


def test_histogram_and_diff(spark):
    sizes = spark.createDataFrame([(n,) for n in (1, 1, 5, 20, 21)], "n int")
    found = {r.bucket: r.n for r in size_histogram(sizes, "n").collect()}
    assert found[1] == 2 and found[20] == 2 and sum(found.values()) == 5 and len(found) == 20
    same = size_histogram(spark.createDataFrame([(4,), (4,)], "n int"), "n").collect()
    assert {r.bucket: r.n for r in same}[1] == 2
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, None), (4, "z")], "k int, v string")
    assert {r.k: r.difference for r in frame_diff(a, b, ["k"], "v").collect()} == {
        1: "changed", 3: "only_left", 4: "only_right"}
