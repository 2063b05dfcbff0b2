import datetime as dt

import pytest

from turnout.schemas import (
    ALS_FINAL_LEDGER, ALS_TUNE_LEDGER, BOOSTING_LEDGER, SOURCE_TABLES, assert_unique_keys, conform,
    tidy_name, typed_frame)
from turnout.sources.ledger import read_metric_ledger, tuning_curve, write_metric_ledger
from turnout.sources.lookups import read_event_zips, read_series_assignments
from turnout.sources.tables import load_tables, snapshot


def test_names_and_types(spark):
    assert [tidy_name(n) for n in ("PersonID", "Event_Date", "State/Province", "Total fee", "EventTypeID")] == [
        "person_id", "event_date", "state_province", "total_fee", "event_type_id"]
    raw = spark.createDataFrame([("1:00", float("nan"))], "Distance string, Miles double")
    row = conform(raw, SOURCE_TABLES["distances"]).first()
    assert (row.distance, row.miles) == ("1:00", None)
    with pytest.raises(ValueError, match="columns not found"):
        conform(raw, SOURCE_TABLES["series"])
    typed = typed_frame(spark.createDataFrame([("7", "1")], "a string, b string"), SOURCE_TABLES["series_events"])
    assert typed.dtypes == [("event_id", "bigint"), ("series_id", "int")]
    with pytest.raises(ValueError, match="repeats"):
        assert_unique_keys(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_tables_with_source_spellings(spark, tmp_path):
    spark.createDataFrame([(1, "Run", None, True, 3)],
                          "EventID int, Event_Name string, Event_Date timestamp, HostEvent boolean, EventTypeID int"
                          ).write.parquet(str(tmp_path / "events"))
    found = load_tables(spark, str(tmp_path), {"events": SOURCE_TABLES["events"]},
                        rename={"HostEvent": "own_event"})["events"]
    assert found.first().own_event is True and found.schema["event_id"].dataType.simpleString() == "bigint"


def test_lookup_files(spark, tmp_path):
    series = tmp_path / "series.csv"
    series.write_text("EventID,Event_Name,Event_Date,SeriesID\n29,'A, run',2015-10-17,0.0\n28,'B',2015-10-10,2.0\n")
    rows = read_series_assignments(spark, str(series)).orderBy("event_id").collect()
    assert [(r.event_id, r.event_name, r.event_date, r.series_id) for r in rows] == [
        (28, "B", dt.date(2015, 10, 10), 2), (29, "A, run", dt.date(2015, 10, 17), 0)]
    zips = tmp_path / "zips.csv"
    zips.write_text(",EventID,Event_Name,Venue_Zip2\n0,8,Dash,98028\n1,9,Night\tRun\t,98102\n")
    rows = read_event_zips(spark, str(zips)).orderBy("event_id").collect()
    assert [(r.event_id, r.event_name, r.venue_zip) for r in rows] == [(8, "Dash", 98028), (9, "Night\tRun", 98102)]


def test_ledgers(spark, tmp_path):
    final = tmp_path / "final.csv"
    final.write_text("als_model,trainvstest,alpha,factors,model_rank,popular_rank,cold_starts_dropped\n"
                     "a,train,80,5,1.5,26.3,7\nb,test,80,5,6.6,27.4\n")
    rows = read_metric_ledger(spark, str(final), ALS_FINAL_LEDGER).orderBy("als_model").collect()
    assert [r.cold_starts_dropped for r in rows] == [7, None] and rows[1].popular_rank == 27.4
    boosted = tmp_path / "gb.csv"
    boosted.write_text("gb_model,train/val/test,learning_rate,max_depth,n_est,subsample,model_rank,popular_rank\n"
                       "base,val,.1,3,100,1,10.6,36.0\nnaive,test,nan,nan,nan,nan,56.9,31.4\n")
    rows = read_metric_ledger(spark, str(boosted), BOOSTING_LEDGER).orderBy("gb_model").collect()
    assert rows[0].learning_rate == 0.1 and rows[1].max_depth is None and rows[1].model_rank == 56.9
    path = str(tmp_path / "tune")
    for model, rank in (("a", 1.0), ("a", 3.0)):
        write_metric_ledger(spark.createDataFrame([(model, 10.0, 5, rank, rank)], ALS_TUNE_LEDGER), path)
    curve = tuning_curve(read_metric_ledger(spark, path), 5).collect()
    assert sorted((r.model_rank, r.mean_popular_rank) for r in curve) == [(1.0, 2.0), (3.0, 2.0)]


def test_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert snapshot(df, str(tmp_path / "s")).collect() == df.collect()
