"""Adapter from the test tables to participation frames, as DataFrames and as SQL.

person = customer, event = product type x order quarter, fee = line price in
thousands, miles = part size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnout.operators.grid import grid_partitions

# order lines in one task of a join, about 600 bytes each with all that follows from them
LINES_PER_TASK = 250_000
# up to this many products go to every task, under 20 MB; more are joined in as many partitions as the lines
LARGE_PART = 200_000

TYPE_NUMBERS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_in_parts(left: DataFrame, right: DataFrame, left_key: str, right_key: str, parts: int) -> DataFrame:
    """Inner join by key in ``parts`` partitions if these are more than the session would use.

    The session's setting is the same for any input, and adaptive execution merges what is more
    than the cores, so a task's sorts and tables would grow with the input. What is grouped by
    the key later stays in these partitions.
    """
    if parts > min(grid_partitions(left), left.sparkSession.sparkContext.defaultParallelism):
        left, right = left.repartition(parts, left_key), right.repartition(parts, right_key)
    return left.join(right, F.col(left_key) == F.col(right_key))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with person, product type and quarter."""
    lines, orders, part = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part"))
    parts = -(-max(lines.count(), orders.count()) // LINES_PER_TASK)
    kind = F.lit(6)
    for name, number in TYPE_NUMBERS.items():
        kind = F.when(F.col("p_type") == name, F.lit(number)).otherwise(kind)
    if part.count() > LARGE_PART:
        # first, so that the rows are left by order
        joined = join_in_parts(join_in_parts(lines, part, "l_partkey", "p_partkey", parts),
                               orders, "l_orderkey", "o_orderkey", parts)
    else:
        joined = join_in_parts(lines, orders, "l_orderkey", "o_orderkey", parts).join(
            F.broadcast(part), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("o_custkey").cast("long").alias("person_id"),
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_no"), F.col("l_returnflag").alias("flag"),
        kind.cast("int").alias("t"), F.year("o_orderdate").alias("y"),
        F.quarter("o_orderdate").alias("q"),
        F.date_trunc("quarter", "o_orderdate").cast("date").alias("qs"),
        F.year("l_shipdate").alias("sy"), F.quarter("l_shipdate").alias("sq"),
        F.date_trunc("quarter", "l_shipdate").cast("date").alias("sqs"),
        F.col("l_extendedprice").alias("price"), F.col("p_size").cast("long").alias("size"),
        F.col("l_quantity").cast("long").alias("qty"))


def _participations(lines: DataFrame) -> DataFrame:
    t, y, q = F.col("t"), F.col("y"), F.col("q")
    grouped = lines.groupBy("person_id", "t", "y", "q", "qs").agg(
        (F.min("price") / 1000).alias("fee"), F.min("size").alias("miles"))
    return grouped.select(
        "person_id", (t * 1000 + (y - 1995) * 4 + q).cast("long").alias("event_id"),
        F.date_add("qs", 14 * (t - 1)).alias("event_date"),
        F.when(t <= 4, t).otherwise(0).alias("series_id"), t.alias("event_type_id"),
        (98000 + (t * 4 + q) % 9).cast("int").alias("venue_zip"), "fee", "miles")


def participations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _participations(order_lines(spark, sf_dir))


def sparse_participations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line, with few events per person: person = order, quarter = quarter of shipping."""
    lines = order_lines(spark, sf_dir)
    return _participations(lines.withColumns({
        "person_id": F.col("order_id"), "y": F.col("sy"), "q": F.col("sq"), "qs": F.col("sqs")}))


def pseudo_score(cells: DataFrame, column: str = "prediction", by: str = "event_id") -> DataFrame:
    """A repeatable score in place of a model's."""
    score = ((F.col("person_id") * 31 + F.col(by) * 17) % 1000).cast("double") / 1000
    return cells.withColumn(column, score)


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty registrations for the cleaning steps."""
    person, order, line, t = (F.col(c) for c in ("person_id", "order_id", "line_no", "t"))

    def pick(number, *values):
        result = F.lit(values[-1])
        for i, value in enumerate(values[:-1]):
            result = F.when(number == i, F.lit(value)).otherwise(result)
        return result

    fee = F.concat(F.col("qty").cast("string"), F.lit(".50"))
    return order_lines(spark, sf_dir).select(
        "person_id", "order_id", "line_no",
        (F.when(line % 2 == 0, 1000).otherwise(0) + t).cast("long").alias("event_id"),
        F.when(order % 7 != 0, 18 + (person * 13 + line) % 60).alias("age"),
        pick(person % 3, "Male", "Female", None).alias("gender"),
        pick(line - 1, "1/2 Marathon", None, "10 k", "5k early start", "22 mile").alias("distance"),
        F.when(line.isin(1, 3, 4) | ((line == 2) & (order % 2 == 0)), None)
        .otherwise(F.col("size").cast("double")).alias("miles"),
        F.when(order % 5 != 0, F.lit("0:45:00.0")).alias("time"),
        F.when(order % 11 == 0, F.lit("comp")).when(order % 11 != 1, fee).alias("total_fee"),
        pick(order % 4, True, False, None).alias("ss_prereg"),
        F.when(order % 3 == 0, F.col("qs")).alias("registration_time"),
        pick(order % 12, "Cash", "cash/comp", "Check", "Authorize", "CC", "cc", "PayPal",
             "PayPal pending", "Comp", "gift", "credit", None).alias("payment_method"),
        pick(order % 8, "no", "NO", "0", "yes", "YES", "-1", "maybe", None).alias("contact"),
        F.when(order % 9 < 6, order % 9 + 1).cast("int").alias("series_id"),
        F.when(t == 6, "Street Scramble").otherwise("Trail Run").alias("event_type"),
        F.when(order % 2 == 0, F.lit("Y")).alias("tshirt"))


# -- the same as SQL -------------------------------------------------------

LI = """li AS (
SELECT CAST(o.o_custkey AS BIGINT) AS person_id, CAST(o.o_orderkey AS BIGINT) AS order_id,
  CAST(l.l_linenumber AS BIGINT) AS line_no, l.l_returnflag AS flag,
  CAST(CASE p.p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
       WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS INT) AS t,
  CAST(year(o.o_orderdate) AS INT) AS y, CAST(quarter(o.o_orderdate) AS INT) AS q,
  CAST(date_trunc('quarter', o.o_orderdate) AS DATE) AS qs,
  CAST(year(l.l_shipdate) AS INT) AS sy, CAST(quarter(l.l_shipdate) AS INT) AS sq,
  CAST(date_trunc('quarter', l.l_shipdate) AS DATE) AS sqs,
  l.l_extendedprice AS price, CAST(p.p_size AS BIGINT) AS size, CAST(l.l_quantity AS BIGINT) AS qty
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""

_PARTICIPATIONS = """
SELECT person_id, CAST(t*1000 + (y-1995)*4 + q AS BIGINT) AS event_id, CAST(qs + 14*(t-1) AS DATE) AS event_date,
  CAST(CASE WHEN t <= 4 THEN t ELSE 0 END AS INT) AS series_id, t AS event_type_id,
  CAST(98000 + (t*4+q) % 9 AS INT) AS venue_zip, min(price)/1000 AS fee, min(size) AS miles
FROM {lines} GROUP BY person_id, t, y, q, qs"""

P = f"{LI},\np AS ({_PARTICIPATIONS.format(lines='li')})"
_SHIPPED = "(SELECT order_id AS person_id, t, sy AS y, sq AS q, sqs AS qs, price, size FROM li) shipped"
S = f"{LI},\ns AS ({_PARTICIPATIONS.format(lines=_SHIPPED)})"

EV = P + """,
ev AS (
SELECT event_id, min(event_date) AS event_date, min(series_id) AS series_id, min(event_type_id) AS event_type_id,
  min(venue_zip) AS venue_zip, CAST(round(avg(fee)) AS INT) AS total_fee_avg, CAST(round(avg(miles)) AS INT) AS miles_avg
FROM p GROUP BY event_id)"""

G = EV + """,
g AS (
SELECT u.person_id, e.event_id, CAST(CASE WHEN x.person_id IS NULL THEN 0 ELSE 1 END AS INT) AS participated,
  e.event_date, e.series_id, e.event_type_id, e.total_fee_avg, e.miles_avg, e.venue_zip
FROM (SELECT DISTINCT person_id FROM p) u CROSS JOIN ev e
LEFT JOIN p x ON x.person_id = u.person_id AND x.event_id = e.event_id)"""

K = G + """,
k AS (SELECT *, CAST((person_id*31 + event_id*17) % 1000 AS DOUBLE)/1000 AS prediction FROM g)"""

D = LI + """,
d AS (
SELECT person_id, order_id, line_no, CAST(CASE WHEN line_no % 2 = 0 THEN 1000 ELSE 0 END + t AS BIGINT) AS event_id,
  CASE WHEN order_id % 7 = 0 THEN NULL ELSE 18 + (person_id*13 + line_no) % 60 END AS age,
  CASE person_id % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE NULL END AS gender,
  CASE line_no WHEN 1 THEN '1/2 Marathon' WHEN 2 THEN NULL WHEN 3 THEN '10 k' WHEN 4 THEN '5k early start' ELSE '22 mile' END AS distance,
  CASE WHEN line_no IN (1,3,4) THEN NULL WHEN line_no = 2 AND order_id % 2 = 0 THEN NULL ELSE CAST(size AS DOUBLE) END AS miles,
  CASE WHEN order_id % 5 = 0 THEN NULL ELSE '0:45:00.0' END AS time,
  CASE order_id % 11 WHEN 0 THEN 'comp' WHEN 1 THEN NULL ELSE concat(CAST(qty AS VARCHAR), '.50') END AS total_fee,
  CASE WHEN order_id % 4 = 0 THEN TRUE WHEN order_id % 4 = 1 THEN FALSE ELSE NULL END AS ss_prereg,
  CASE WHEN order_id % 3 = 0 THEN qs ELSE NULL END AS registration_time,
  CASE order_id % 12 WHEN 0 THEN 'Cash' WHEN 1 THEN 'cash/comp' WHEN 2 THEN 'Check' WHEN 3 THEN 'Authorize' WHEN 4 THEN 'CC' WHEN 5 THEN 'cc'
    WHEN 6 THEN 'PayPal' WHEN 7 THEN 'PayPal pending' WHEN 8 THEN 'Comp' WHEN 9 THEN 'gift' WHEN 10 THEN 'credit' ELSE NULL END AS payment_method,
  CASE order_id % 8 WHEN 0 THEN 'no' WHEN 1 THEN 'NO' WHEN 2 THEN '0' WHEN 3 THEN 'yes' WHEN 4 THEN 'YES' WHEN 5 THEN '-1' WHEN 6 THEN 'maybe' ELSE NULL END AS contact,
  CASE WHEN order_id % 9 < 6 THEN CAST(order_id % 9 + 1 AS INT) ELSE NULL END AS series_id,
  CASE WHEN t = 6 THEN 'Street Scramble' ELSE 'Trail Run' END AS event_type,
  CASE WHEN order_id % 2 = 0 THEN 'Y' ELSE NULL END AS tshirt
FROM li)"""

# labels of the positional split of the grid, and of the participations
SPLIT_G = G + """,
gp AS (SELECT *, row_number() OVER (ORDER BY event_date, event_id, person_id) AS pos, count(*) OVER () AS n FROM g),
gs AS (SELECT *, CASE WHEN pos > round(n*0.8) THEN 'test' WHEN pos > round(round(n*0.8)*0.8) THEN 'validate' ELSE 'train' END AS split FROM gp)"""

SPLIT_P = P + """,
pp AS (SELECT *, row_number() OVER (ORDER BY event_date, event_id, person_id) AS pos, count(*) OVER () AS n FROM p),
ps AS (SELECT *, CASE WHEN pos > round(n*0.8) THEN 'test' WHEN pos > round(round(n*0.8)*0.8) THEN 'validate' ELSE 'train' END AS split FROM pp)"""

TOP5 = K + """,
top AS (SELECT person_id, event_id, participated, prediction, CAST(place AS INT) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY prediction DESC, event_id) AS place FROM k) WHERE place <= 5)"""

# person and event summaries of the sparse view
PERSONS = S + """,
people AS (
SELECT person_id, count(*) AS event_count, min(event_date) AS first_date,
  CASE WHEN count(*) = 1 THEN 'One Off'
       WHEN date_diff('day', min(event_date), max(CASE WHEN rn = 2 THEN event_date END)) < 183 THEN 'Under 183 days'
       ELSE 'Over 183 days' END AS repeat_lag,
  CASE WHEN count(*) = 1 THEN 'One Off'
       WHEN count(DISTINCT series_id) = 1 THEN 'Single - ' || CAST(min(series_id) AS VARCHAR) ELSE 'Multiple' END AS cross_series
FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY event_date, event_id) AS rn FROM s) GROUP BY person_id)"""

EVENTS = PERSONS + """,
v AS (SELECT s.person_id, s.event_id, s.event_date, s.series_id, u.repeat_lag, u.cross_series, s.event_date = u.first_date AS ft
      FROM s JOIN people u ON s.person_id = u.person_id),
es AS (
SELECT event_id, min(event_date) AS event_date, min(series_id) AS series_id, count(*) AS total_part_count,
  count(*) FILTER (WHERE starts_with(cross_series, 'Single')) AS repeat_single_series,
  count(*) FILTER (WHERE cross_series = 'Multiple') AS repeat_multi_series,
  count(*) FILTER (WHERE cross_series = 'One Off') AS single_attend,
  count(*) FILTER (WHERE ft) AS first_timers,
  count(*) FILTER (WHERE ft AND repeat_lag = 'Under 183 days') AS repeat_under,
  count(*) FILTER (WHERE ft AND repeat_lag = 'Over 183 days') AS repeat_over
FROM v GROUP BY event_id),
er AS (SELECT *, CAST(trunc(100.0*repeat_under/nullif(first_timers,0)) AS INT) AS pct_under,
  CAST(trunc(100.0*repeat_over/nullif(first_timers,0)) AS INT) AS pct_over FROM es),
lim AS (SELECT max(event_date) AS last_date FROM er WHERE event_date <= (SELECT max(event_date) FROM er) - 183),
ob AS (SELECT er.* FROM er, lim WHERE event_date < last_date OR (event_date = last_date AND event_id =
  (SELECT min(e2.event_id) FROM er e2, lim l2 WHERE e2.event_date = l2.last_date)))"""
