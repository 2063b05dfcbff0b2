import datetime as dt
import random

from pyspark.sql import functions as F

from turnout.operators.profile import prediction_describe
from turnout.operators import split
from turnout.operators.attendance import event_roster
from turnout.operators.grid import make_grid, pair_up, participation_grid
from turnout.operators.position import exact_quantiles, nth_ids, running_position
from turnout.operators.retention import person_summary

DAY = dt.date(2017, 1, 1)


def participations(spark, people=23, events=11, seed=3, repeat=0):
    """Random participations; dates tie in pairs of events, series alternate."""
    pick = random.Random(seed)
    rows = []
    for person in range(people):
        for event in pick.sample(range(events), pick.randint(1, 5)):
            row = (person * 7, event, DAY + dt.timedelta(days=event // 2 * 30), event % 2, event % 3,
                   98000 + event % 4, 10.0 + event, event % 5)
            rows += [row] * (1 + (pick.random() < repeat))
    return spark.createDataFrame(
        rows, "person_id long, event_id long, event_date date, series_id int, event_type_id int, "
              "venue_zip int, fee double, miles long")


def expected_split(rows, shares=(0.8, 0.8)):
    ordered = sorted(rows, key=lambda r: (r.event_date, r.event_id, r.person_id))
    outer = int(len(ordered) * shares[0] + 0.5)
    inner = int(outer * shares[1] + 0.5)
    return {(r.person_id, r.event_id): "train" if i < inner else "validate" if i < outer else "test"
            for i, r in enumerate(ordered)}


def test_grid_has_every_pair_once(spark):
    parts = participations(spark, repeat=0.3)
    seen = {(r.person_id, r.event_id) for r in parts.collect()}
    cells = participation_grid(parts).collect()
    events = {e for _, e in seen}
    assert len(cells) == len({(c.person_id, c.event_id) for c in cells}) == 23 * len(events)
    assert {(c.person_id, c.event_id) for c in cells if c.participated} == seen


def test_slots_give_the_same_pairs(spark):
    people = spark.range(50).select(F.col("id").alias("person_id"))
    items = spark.range(7).select(F.col("id").alias("item"))
    small = set(map(tuple, pair_up(people, items, 7).collect()))
    large = [tuple(r) for r in pair_up(people, items, 7, broadcast_limit=3, slots=5).collect()]
    assert set(large) == small and len(large) == 350


def test_split_matches_positions(spark):
    grid = make_grid(participations(spark))
    cells = split.split_cells(grid).collect()
    assert {(c.person_id, c.event_id): c.split for c in cells} == expected_split(cells)
    for series in (0, 1):
        by = [c for c in split.split_cells(grid, by="series_id").collect() if c.series_id == series]
        assert {(c.person_id, c.event_id): c.split for c in by} == expected_split(by)


def test_split_of_rows_and_reports(spark):
    parts = participations(spark)
    rows = split.split_rows(parts).collect()
    assert {(r.person_id, r.event_id): r.split for r in rows} == expected_split(rows)
    labelled = split.split_rows(parts)
    report = {r.key: r for r in split.split_overlap_report(labelled, ["person_id", "series_id"]).collect()}
    people = {s: {r.person_id for r in rows if r.split == s} for s in ("train", "validate", "test")}
    assert report["person_id"].in_train == len(people["train"])
    assert report["person_id"].in_train_and_test == len(people["train"] & people["test"])
    cold = split.cold_start_report(labelled, "person_id").first()
    new = people["validate"] - people["train"]
    assert (cold.cold_keys, cold.cold_rows) == (
        len(new), sum(r.split == "validate" and r.person_id in new for r in rows))


def test_repeated_rows_are_cut_by_row(spark):
    rows = spark.createDataFrame([(1, 7, "2020-01-01")] * 10, "person_id long, event_id long, d string").selectExpr(
        "person_id", "event_id", "CAST(d AS date) AS event_date")
    sides = [r.split for r in split.ordered_cut(rows, 0.5).collect()]
    assert (sides.count("train"), sides.count("validate")) == (5, 5)


def test_no_row_is_lost_or_doubled(spark):
    rows = spark.createDataFrame(
        [(p, e, None if e == 3 else f"2020-0{1 + ((p or 0) % 2) * (e == 2)}-01", None if e == 1 else e % 2)
         for e in (1, 2, 3) for p in [*range(9), None]],
        "person_id long, event_id long, d string, series_id int").selectExpr(
        "person_id", "event_id", "CAST(d AS date) AS event_date", "series_id")
    for by in (None, "series_id"):
        found = split.split_rows(rows, by=by).collect()
        key = lambda r: (str(r.person_id), r.event_id, str(r.event_date), str(r.series_id))
        assert sorted(map(key, found)) == sorted(map(key, rows.collect()))
    found = split.split_rows(rows).collect()
    counts = {s: sum(r.split == s for r in found) for s in ("train", "validate", "test")}
    assert counts == {"train": 19, "validate": 5, "test": 6}
    assert all(r.event_date is None for r in found if r.split == "test")


def test_quartiles_of_a_null_label(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 2.0)], "participated int, prediction double")
    found = {r.participated: r.q50 for r in prediction_describe(rows).collect()}
    assert found == {None: 2.0, 1: 2.0}


def test_split_ranges_cover_each_row_once(spark):
    cuts = split.standard_cuts()
    grid = split.split_grid(make_grid(participations(spark)), cuts)
    cells = grid.cells(*split.bound_columns(cuts)).withColumn("split", split.split_label(cuts))
    for name in ("train", "validate", "test"):
        low, high = split.split_range(cuts, name)
        inside = (F.col("person_id") > low) & (F.col("person_id") <= high)
        assert cells.filter(inside != (F.col("split") == name)).count() == 0


def test_positions_and_quantiles(spark):
    values = [random.Random(5).randint(0, 30) for _ in range(200)]
    rows = spark.createDataFrame([(i, v, v / 7) for i, v in enumerate(values)], "i int, v int, x double")
    placed = running_position(rows, "v", ["i"]).orderBy("position").collect()
    assert [(r.v, r.i) for r in placed] == sorted((v, i) for i, v in enumerate(values))
    labelled = rows.withColumn("g", F.col("i") % 3)
    mine = {r.g: r for r in exact_quantiles(labelled, "g", "x", {"a": 0.25, "b": 0.5, "c": 0.9}).collect()}
    theirs = labelled.groupBy("g").agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9))).alias("q"))
    for r in theirs.collect():
        assert max(abs(x - y) for x, y in zip(r.q, (mine[r.g].a, mine[r.g].b, mine[r.g].c))) < 1e-9


def test_roster_pages_hold_everybody(spark, monkeypatch):
    monkeypatch.setattr("turnout.operators.attendance.ROSTER_RANGE", 20)
    parts = participations(spark, repeat=0.4)
    pages = event_roster(parts).collect()
    assert {(p.event_id, x) for p in pages for x in p.person_ids} == {
        (r.event_id, r.person_id) for r in parts.collect()}
    assert max(len(p.person_ids) for p in pages) <= 20 and all(p.n_people == len(p.person_ids) for p in pages)


def test_boundaries_with_sparse_ids(spark):
    ids = [-(2**62), -5, 0, 3, 3, 2**40, 2**40 + 1, 2**62]
    members = spark.createDataFrame([(0, i, 1) for i in ids], "g int, person_id long, n int")
    wanted = spark.createDataFrame([(0, q) for q in range(1, 9)], "g int, quota long")
    found = {r.quota: r.boundary_id for r in nth_ids(members, wanted, "g", "person_id").collect()}
    assert found == {i + 1: x for i, x in enumerate(ids)}


def test_one_person_and_one_event_with_a_third_of_all_rows(spark):
    hot = [(1, e, DAY, 0, 0, 98000, 1.0, 1) for e in range(5)] * 40 + [
        (p, 2, DAY, 0, 0, 98000, 1.0, 1) for p in range(200)]
    parts = spark.createDataFrame(hot, participations(spark).schema)
    people = {r.person_id: r for r in person_summary(parts).collect()}
    assert people[1].event_count == 201 and len(people[1].history) == 5
    assert people[1].repeat_lag == "Under 183 days" and people[7].repeat_lag == "One Off"
    cells = participation_grid(parts)
    assert cells.count() == 1000 and cells.agg(F.sum("participated")).first()[0] == 204
