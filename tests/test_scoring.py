import datetime as dt

from pyspark.sql import functions as F

from turnout.functions.scores import UNROLLED, dot
from turnout.operators import als
from turnout.operators.grid import make_grid
from turnout.operators.split import split_grid, standard_cuts

CUTS = standard_cuts()


def grid_of(spark, people=12, events=20):
    rows = [(p, e, dt.date(2016, 1, 1) + dt.timedelta(days=e), e % 4, 1, 98000 + e % 3, 10.0, 5.0)
            for p in range(people) for e in range(events) if (p + e) % 3 == 0]
    rows.append((people, 1, dt.date(2016, 1, 2), 1, 1, 98001, 10.0, 5.0))
    return split_grid(make_grid(spark.createDataFrame(
        rows, "person_id long, event_id long, event_date date, series_id int, event_type_id int, "
              "venue_zip int, fee double, miles double")), CUTS)


def test_scores_are_computed_once_per_person_and_item(spark, monkeypatch):
    grid = grid_of(spark)
    fitted = {f"{item}_": als.fit_recommender(grid, item, CUTS, rank=3, max_iter=2) for item in ("series_id", "venue_zip", "event_id")}
    ready, _, extra = als.attach(grid, fitted)
    assert set(extra) == {"series_id__scores", "series_id__place", "venue_zip__scores", "venue_zip__place",
                          "event_id__user", "event_id__item"}
    assert ready.people.select(F.max(F.size("series_id__scores"))).first()[0] == 4
    columns = ["person_id", "event_id", "participated", "split", *fitted]
    listed = als.score_cells(grid, fitted, CUTS).select(*columns).orderBy("person_id", "event_id").collect()
    monkeypatch.setattr(als, "LISTED_ITEMS", -1)
    assert listed == als.score_cells(grid, fitted, CUTS).select(*columns).orderBy("person_id", "event_id").collect()
    assert len(listed) == 13 * 20 and any(r["event_id_"] is None for r in listed)


def test_long_products_are_folded(spark):
    size = UNROLLED + 1
    rows = spark.createDataFrame([([0.1 * i for i in range(size)], [1.5 - i for i in range(size)]), (None, [1.0] * size)],
                                 "a array<float>, b array<float>")
    found = dot(F.col("a"), F.col("b"), size)
    assert str(found).count("*") <= 1
    unrolled = sum((F.col("a")[i].cast("double") * F.col("b")[i].cast("double") for i in range(1, size)),
                   F.col("a")[0].cast("double") * F.col("b")[0].cast("double"))
    assert [r.x == r.y for r in rows.select(found.alias("x"), unrolled.alias("y")).collect()] == [True, True]
