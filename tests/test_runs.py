"""Whole runs and operators on skewed or outlying values."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_grid_split import participations
from turnout.operators import als, ensemble, evaluate
from turnout.operators.grid import make_grid
from turnout.operators.position import STEP_BITS, exact_quantiles, nth_ids, ranged_total
from turnout.operators.profile import prediction_describe
from turnout.operators.split import split_grid, standard_cuts
from turnout.plans.audience import audience_run
from turnout.plans.preparation import DETAILS, participation_core, participation_details
from turnout.plans.recommendation import TEST_CUT, final_ledger, naive_ranks
from turnout.schemas import SOURCE_TABLES
from turnout.sources.tables import load_checked


def test_audience_in_one_call(spark):
    parts = participations(spark, people=40, events=12)
    details = parts.withColumns({
        "event_name": F.concat(F.lit("Run "), F.col("event_id")), "event_type": F.lit("Trail Run"),
        "gender": F.when(F.col("person_id") % 4 == 0, "Female").otherwise("Male"),
        "age": (20 + F.col("person_id")).cast("int")})
    scored = parts.select("person_id").distinct().crossJoin(parts.select("event_id").distinct()).withColumn(
        "prediction", (F.col("event_id") * 7 + F.col("person_id")) % 5 / 5)
    found = audience_run(scored, details, k=3, n=2)
    top = found["top_lists"].collect()
    people = {r.person_id for r in top}
    assert len(top) == 3 * len(people) and found["snapshot"].count() == 2
    counts = {r.event_id: r.top_count for r in found["event_counts"].collect()}
    for r in found["gender_share"].collect():
        mine = [t.person_id for t in top if t.event_id == r.event_id]
        assert r.audience == counts[r.event_id] == len(mine)
        assert r.female_share == pytest.approx(sum(p % 4 == 0 for p in mine) / len(mine))
    ages = {r.event_id: r.audience_age for r in found["age"].collect()}
    assert all(ages[e] == pytest.approx(sum(20 + t.person_id for t in top if t.event_id == e) / n, abs=0.051)
               for e, n in counts.items())
    assert {r.event_name for r in found["event_details"].collect()} == {f"Run {e}" for e in counts}


def test_details_go_with_the_core(spark):
    clean = participations(spark).withColumnsRenamed({"fee": "total_fee", "miles": "miles2"}).withColumns(
        {c: F.lit(None).cast("string") for c in DETAILS})
    core = participation_core(clean)
    assert participation_details(clean).columns == [*core.columns, "event_name", "event_type", "gender", "age"]
    assert participation_details(clean).count() == core.count()


def test_final_ledger_and_plain_ensembles(spark):
    grid = split_grid(make_grid(participations(spark, people=50, events=20)), TEST_CUT, "series_id")
    fitted = als.fit_five(grid, TEST_CUT, "trainval", "trainval", ranks={k: 2 for k in (
        "series_id", "event_type_id", "venue_zip", "total_fee_avg", "miles_avg")})
    cells = als.score_cells(grid, fitted, TEST_CUT, "trainval").persist()
    rows = final_ledger(grid, fitted).collect()
    assert len(rows) == 10 and {r.split for r in rows} == {"trainval", "test"}
    for r in rows:
        part = cells.filter(F.col("split") == r.split).withColumn("prediction", F.col(f"{r.als_model}_prediction"))
        assert r.cold_starts_dropped == part.filter("prediction IS NULL").count()
        known = part.filter("prediction IS NOT NULL")
        assert r.model_rank == pytest.approx(evaluate.rank_bar(known).first()[0], abs=1e-6)
        assert r.popular_rank == pytest.approx(evaluate.popularity_rank_bar(known, r.als_model).first()[0])
    ledger = {(r.gb_model, r.split): r.model_rank for r in naive_ranks(cells).collect()}
    assert len(ledger) == 6
    test = ensemble.mean_ensemble(ensemble.fill_prediction_mean(cells.filter("split = 'test'")))
    assert ledger["naive_mean", "test"] == pytest.approx(evaluate.rank_bar(test).first()[0])
    cells.unpersist()


def test_vectors_of_fifty_thousand_values(spark):
    rows = spark.range(50_000).select(F.col("id"), F.format_string("%06d", "id").alias("code"), F.lit("one").alias("same"))
    known = ensemble.vocabulary(rows, ["code", "same"])
    assert known.filter("column = 'code'").agg(F.min("place"), F.max("place"), F.count_distinct("place")).first()[:] == (0, 49_999, 50_000)
    later = rows.filter("id IN (0, 1, 49999)").unionByName(spark.createDataFrame(
        [(-1, "unseen", None), (-2, None, "one")], "id long, code string, same string"))
    found = ensemble.dummy_vectors(later, known).select(
        "id", ensemble.vector_size("code_dummies").alias("n"), ensemble.vector_place("code_dummies").alias("at"), "same_dummies").collect()
    assert {(r.id, r.at) for r in found} == {(0, None), (1, 0), (49_999, 49_998), (-1, None), (-2, None)}
    assert {r.n for r in found} == {49_999} and all(r.same_dummies.toArray().tolist() == [0.0] for r in found)


def test_checked_files(spark, tmp_path):
    file = tmp_path / "events.csv"
    file.write_text("EventID,Event_Name,Event_Date,HostEvent,EventTypeID\n1,Run,2015-10-17,true,3\n2,,never,false,4\n"
                    "x,A,2015-10-17,maybe,5\n3,short\n,B,2015-10-17,,\n4,C,,true,1,more\n")
    rows, rejected = load_checked(spark, str(file), SOURCE_TABLES["events"], rename={"HostEvent": "own_event"},
                                  required=("event_id",))
    assert [(r.event_id, r.event_name, r.own_event, r.event_type_id) for r in rows.collect()] == [(1, "Run", True, 3)]
    assert sorted(r.reasons for r in rejected.collect()) == [
        ["event_date"], ["event_id"], ["event_id", "own_event"], ["malformed"], ["malformed"]]
    typed, none = load_checked(spark, str(file), SOURCE_TABLES["events"], rename={"HostEvent": "own_event"})
    assert typed.dtypes[0] == ("event_id", "bigint") and typed.count() + none.count() == 6


def test_ties_are_many_ranges(spark, monkeypatch):
    items = spark.range(100_000).select(F.col("id").alias("item"), F.lit(3).alias("attendance"), F.lit(1.0).alias("_best"))
    monkeypatch.setattr(evaluate, "_item_counts", lambda *_: items)
    placed = evaluate.popularity_rank(items, "item")
    assert placed.agg(F.sum("rank_ui")).first()[0] == pytest.approx(sum(i / 1000 for i in range(100_000)))
    largest = placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 60_000


def test_one_outlying_id_or_value(spark):
    rng = random.Random(3)
    ids = [*range(5000), 2**62 + 5, -(2**61)]
    members = spark.createDataFrame([(0, i, 1 + i % 3) for i in ids], "g int, person_id long, n int")
    order = sorted((i, 1 + i % 3) for i in ids)
    wanted = [1, 2, 700, 5000, sum(n for _, n in order)]
    found = {r.quota: (r.boundary_id, r.boundary_rows) for r in nth_ids(
        members, spark.createDataFrame([(0, q) for q in wanted], "g int, quota long"), "g", "person_id").collect()}
    for quota in wanted:
        before = 0
        for i, n in order:
            if before + n >= quota:
                assert found[quota] == (i, quota - before)
                break
            before += n
    assert STEP_BITS == 16
    values = [rng.random() for _ in range(300)] + [1e300]
    rows = spark.createDataFrame([(i % 2, x) for i, x in enumerate(values)] + [(0, None), (1, float("nan"))],
                                 "participated int, prediction double")
    described = {r.participated: r for r in prediction_describe(rows).collect()}
    want = rows.filter("NOT isnan(prediction)").groupBy("participated").agg(
        F.percentile("prediction", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.count("prediction").alias("n"),
        F.avg("prediction").alias("mean"), F.stddev_samp("prediction").alias("std")).collect()
    for r in want:
        mine = described[r.participated]
        assert (mine.q25, mine.q50, mine.q75) == pytest.approx(r.q) and mine.n == r.n
        assert (mine.mean, mine.std) == pytest.approx((r["mean"], r["std"]))
    assert exact_quantiles(rows.limit(0), "participated", "prediction", {"a": 0.5}).count() == 0


def test_totals_over_ranges(spark):
    rows = spark.createDataFrame([(i, i % 4, float(i % 7)) for i in range(500)], "i int, n int, x double")
    found = ranged_total(rows, [F.desc("x"), F.col("i")], F.col("n")).collect()
    before = 0
    for r in sorted(found, key=lambda r: (-r.x, r.i)):
        assert r.before == before
        before += r.n


def test_percentile_rank_by_position(spark):
    rows = [(1, 0.9, 1), (1, 0.5, 0), (1, 0.5, 1), (1, 0.1, 0), (1, None, 1), (2, 0.3, 1)]
    df = spark.createDataFrame(rows, "person_id int, prediction double, participated int")
    ranks = sorted(r.percent_rank for r in evaluate.percentile_rank(df).filter("person_id = 1").collect())
    assert ranks == [0, 25, 25, 75, 100]
    assert evaluate.percentile_rank_bar(df).first()[0] == pytest.approx((0 + 25 + 100 + 0) / 4)
    assert standard_cuts()["test"] == TEST_CUT["test"]
