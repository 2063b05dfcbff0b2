import datetime as dt

from turnout.catalog import counts, views

DAY = dt.datetime(2016, 1, 5)


def write_tables(spark, folder, orders=60, per_order=4):
    kinds = list(views.TYPE_NUMBERS)
    spark.createDataFrame(
        [(o, o % 7, DAY + dt.timedelta(days=o)) for o in range(orders)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(p, kinds[p % len(kinds)], p + 1) for p in range(9)],
        "p_partkey long, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame(
        [(o if o else None, (o + n) % 9, n, "A", DAY + dt.timedelta(days=o + 30 * n), 10.0 * n, 2.0)
         for o in range(orders) for n in range(per_order)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp, "
        "l_extendedprice double, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    folder = write_tables(spark, tmp_path)
    key = lambda row: tuple(map(str, row))
    lines = sorted(views.order_lines(spark, folder).collect(), key=key)
    events = sorted(counts.sparse_events(spark, folder).collect(), key=key)
    assert len(lines) == 59 * 4
    monkeypatch.setattr(views, "LINES_PER_TASK", 10)
    for limit in (views.LARGE_PART, 5):
        monkeypatch.setattr(views, "LARGE_PART", limit)
        # 240 lines in tasks of 10; the session's setting is 4, and stays in use for smaller tables
        assert counts.sparse_people(spark, folder).rdd.getNumPartitions() == 24
        assert sorted(views.order_lines(spark, folder).collect(), key=key) == lines
        assert sorted(counts.sparse_events(spark, folder).collect(), key=key) == events


def test_tasks_of_lines_are_not_merged(spark, tmp_path, monkeypatch):
    folder = write_tables(spark, tmp_path)
    key = lambda row: tuple(map(str, row))
    events = sorted(counts.sparse_events(spark, folder).collect(), key=key)
    monkeypatch.setattr(views, "LINES_PER_TASK", 10)
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        # more than the 24 that the lines ask for; adaptive execution would merge them
        spark.conf.set("spark.sql.shuffle.partitions", 100)
        for limit in ("-1", threshold):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert counts.sparse_people(spark, folder).rdd.getNumPartitions() >= 24
            assert sorted(counts.sparse_events(spark, folder).collect(), key=key) == events
        spark.conf.set("spark.sql.shuffle.partitions", setting)
        # products without a broadcast join: nothing is moved by product, unless they are many
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = views.order_lines(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(l_partkey" not in plan and "hashpartitioning(l_orderkey" in plan
        monkeypatch.setattr(views, "LARGE_PART", 5)
        plan = views.order_lines(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(l_partkey" in plan and ", 24)" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", setting)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
