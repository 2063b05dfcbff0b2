"""Quality of scores.

``rank_bar`` is the expected position of attended items in a person's list, 0 the
top and 100 the bottom, after Hu, Koren and Volinsky (2008). The position of an
item is measured by its score relative to the person's best score, not by its
rank: ``(1 - prediction / best) * 100``.

``actual`` may be a 0/1 flag per row or a count of attended rows that share the
item and thus the score; the sums are the same.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnout.operators.position import ranged_total
from turnout.session import cut_lineage


def _present(prediction: str) -> Column:
    return F.nanvl(F.col(prediction).cast("double"), F.lit(None))


def user_rank_ui(scored: DataFrame, person: str = "person_id",
                 prediction: str = "prediction") -> DataFrame:
    """Adds ``rank_ui`` per row; 0 for people whose best score is not above 0."""
    best = F.max(_present(prediction)).over(W.partitionBy(person))
    share = (1 - F.try_divide(_present(prediction), best)) * 100
    return scored.withColumn("rank_ui", F.when(best > 0, share).otherwise(F.lit(0.0)))


def rank_detail(scored: DataFrame, person: str = "person_id", actual: str = "participated",
                prediction: str = "prediction") -> DataFrame:
    """Per person: rows, best score, sum of positions of attended items, attended items.

    The sum of ``(1 - p / best) * 100`` over attended items needs only the person's
    sums, so this is one hash aggregate with partial aggregation.
    """
    p, a = _present(prediction), F.col(actual)
    sums = scored.groupBy(person).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(p).alias("max_prediction"),
        F.sum(a).alias("attended"), F.sum(a * p).alias("_scored"))
    weighted = (F.col("attended") - F.try_divide("_scored", "max_prediction")) * 100
    return sums.select(
        person, "n_rows", "max_prediction",
        # no position is below 0: with equal scores the quotient may be above the count by its rounding
        F.when(F.col("max_prediction") > 0, F.greatest(weighted, F.lit(0.0))).otherwise(F.lit(0.0)).alias("weighted_rank"),
        "attended")


def rank_bar(scored: DataFrame, person: str = "person_id", actual: str = "participated",
             prediction: str = "prediction") -> DataFrame:
    """One row with ``rank_bar``; 100 if the best score of all is exactly 0."""
    detail = rank_detail(scored, person, actual, prediction)
    mean = F.try_divide(F.sum("weighted_rank"), F.sum("attended"))
    best = F.max("max_prediction")
    return detail.agg(F.when(best == 0, F.lit(100.0)).otherwise(mean).alias("rank_bar"))


def percentile_rank(scored: DataFrame, person: str = "person_id", prediction: str = "prediction") -> DataFrame:
    """Adds ``percent_rank`` per row: the share of the person's other rows with a better score, times 100."""
    better = W.partitionBy(person).orderBy(_present(prediction).desc_nulls_last())
    return scored.withColumn("percent_rank", F.percent_rank().over(better) * 100)


def percentile_rank_bar(scored: DataFrame, person: str = "person_id", actual: str = "participated",
                        prediction: str = "prediction") -> DataFrame:
    """One row with the mean ``percent_rank`` of attended rows; by position in the list, not by relative score."""
    ranked = percentile_rank(scored, person, prediction)
    return ranked.agg(F.try_divide(F.sum(F.col(actual) * F.col("percent_rank")), F.sum(actual)).alias("percentile_rank_bar"))


def _item_counts(scored: DataFrame, item: str, actual: str, prediction: str) -> DataFrame:
    """Attendance and best score per item, stored: rows are read once for all that follows."""
    return cut_lineage(scored.groupBy(item).agg(
        F.sum(actual).alias("attendance"), F.max(_present(prediction)).alias("_best")))


def _placed(counts: DataFrame, item: str) -> DataFrame:
    attended = counts.filter("attendance > 0")
    n_items = attended.agg(F.count(F.lit(1))).scalar()
    return ranged_total(attended, [F.desc("attendance"), F.col(item)], F.lit(1)).select(
        item, "attendance", (F.col("before") / n_items * 100).alias("rank_ui"))


def popularity_rank(scored: DataFrame, item: str, actual: str = "participated",
                    prediction: str = "prediction") -> DataFrame:
    """Items by attendance: item, attendance, ``rank_ui`` = position / items * 100.

    Positions start at 0, ties go by item, items nobody attended are not listed.
    """
    return _placed(_item_counts(scored, item, actual, prediction), item)


def popularity_rank_bar(scored: DataFrame, item: str, actual: str = "participated",
                        prediction: str = "prediction") -> DataFrame:
    """``rank_bar`` of recommending the most attended items to everybody.

    All attended rows of an item have the item's position, so the item table with
    its counts suffices. Like ``rank_bar`` it is 100 if the best score is exactly 0.
    """
    counts = _item_counts(scored, item, actual, prediction)
    best = counts.agg(F.max("_best")).scalar()
    return _mean_place(counts, item).select(
        F.when(best == 0, F.lit(100.0)).otherwise(F.col("mean")).alias("popularity_rank_bar"))


def _mean_place(counts: DataFrame, item: str) -> DataFrame:
    return _placed(counts, item).agg(F.try_divide(
        F.sum(F.col("attendance") * F.col("rank_ui")), F.sum("attendance")).alias("mean"))


def popularity_mean(rows: DataFrame, item: str, actual: str = "participated") -> DataFrame:
    """One row with ``popularity_mean``: as ``popularity_rank_bar``, whatever any model scores.

    ``rows`` may be attended ones alone; the others change nothing.
    """
    counts = cut_lineage(rows.groupBy(item).agg(F.sum(actual).alias("attendance")))
    return _mean_place(counts, item).withColumnRenamed("mean", "popularity_mean")


def fill_with_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values of each column become the column's mean, from one pass over the frame.

    A column without any value becomes 0, the score of a pair nothing is known about.
    """
    means = df.agg(F.struct(*[F.avg(_present(c)).alias(c) for c in columns]).alias("means")).scalar()
    return df.withColumns(
        {c: F.coalesce(_present(c), means.getField(c), F.lit(0.0)) for c in columns})


def regression_metrics(scored: DataFrame, label: str = "participated",
                       prediction: str = "prediction") -> DataFrame:
    """rmse, mse, r2 and mae; a missing prediction counts as the mean prediction."""
    y = F.col(label).cast("double")
    mean = scored.agg(F.avg(_present(prediction)).alias("mean")).scalar()
    error = y - F.coalesce(_present(prediction), mean)
    mse = F.avg(error * error)
    return scored.agg(
        F.sqrt(mse).alias("rmse"), mse.alias("mse"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"), F.avg(F.abs(error)).alias("mae"))


def r2_score(scored: DataFrame, label: str = "participated",
             prediction: str = "prediction") -> DataFrame:
    return regression_metrics(scored, label, prediction).select("r2")


def ml_metric(scored: DataFrame, metric: str, label: str = "participated",
              prediction: str = "prediction") -> float:
    """One of the metrics through Spark ML, after the same fill."""
    filled = fill_with_mean(scored, [prediction]).withColumn(label, F.col(label).cast("double"))
    return RegressionEvaluator(
        metricName=metric, labelCol=label, predictionCol=prediction).evaluate(filled)


class RankBarEvaluator(Evaluator):
    """``rank_bar`` as a tuning metric; smaller is better."""

    userCol = Param(Params._dummy(), "userCol", "person column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "attendance column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "score column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, userCol="person_id", labelCol="participated", predictionCol="prediction"):
        super().__init__()
        self._set(userCol=userCol, labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        get = self.getOrDefault
        found = rank_bar(dataset, get(self.userCol), get(self.labelCol), get(self.predictionCol)).first()[0]
        return float("nan") if found is None else found

    def isLargerBetter(self) -> bool:
        return False
