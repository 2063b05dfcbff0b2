"""Predictions of several models side by side, and models on top of them."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import unwrap_udt

from turnout import fixed_values as fv
from turnout.functions.scores import hybrid_label, k_extreme_mean, mean_of
from turnout.operators import boosting
from turnout.operators.als import SEED
from turnout.operators.evaluate import fill_with_mean, popularity_rank_bar, rank_bar
from turnout.operators.position import ranged_total
from turnout.schemas import BOOSTING_LEDGER
from turnout.session import cut_lineage

PREDICTIONS = [f"{item}_prediction" for item in fv.RECOMMENDER_RANKS]

# most distinct values that become columns of their own: a frame's column names are known to the driver
MAX_LEVELS = 1_000


def merge_predictions(data: DataFrame, preds: DataFrame, item: str,
                      on_feature: bool = False) -> DataFrame:
    """Left-join one model's predictions as ``<item>_prediction`` and drop the item column.

    The key is person and event. ``on_feature`` joins on person, attendance, date and
    item value instead, where events that share all of these multiply rows.
    """
    keys = (["person_id", "participated", "event_date", item] if on_feature
            else ["person_id", "event_id"])
    named = preds.select(*keys, F.col("prediction").alias(f"{item}_prediction"))
    return data.join(named, keys, "left").drop(item)


def merge_all_predictions(data: DataFrame, preds: dict[str, DataFrame]) -> DataFrame:
    """Fold ``merge_predictions`` over models, ``{item: predictions}``.

    For separately stored predictions; ``score_cells`` gives the same frame for
    fitted models without any join of cells.
    """
    return reduce(lambda df, pair: merge_predictions(df, pair[1], pair[0]), preds.items(), data)


def merge_labels_predictions(data: DataFrame, preds: DataFrame) -> DataFrame:
    keys = ["person_id", "event_id", "participated", "event_date"]
    return data.join(preds.select(*keys, "prediction"), keys, "left")


def attach_user_features(data: DataFrame, users: DataFrame) -> DataFrame:
    """Gender and mean age per person next to each row."""
    return data.join(users.select("person_id", "gender", "age_avg"), "person_id", "left")


def mean_ensemble(df: DataFrame, columns: list[str] = PREDICTIONS) -> DataFrame:
    return df.withColumn("prediction", mean_of(*[F.col(c) for c in columns]))


def extreme_ensemble(df: DataFrame, columns: list[str] = PREDICTIONS, k: int = 2,
                     which: str = "smallest") -> DataFrame:
    return df.withColumn("prediction", k_extreme_mean([F.col(c) for c in columns], k, which))


def fill_prediction_mean(df: DataFrame, columns: list[str] = PREDICTIONS) -> DataFrame:
    """Cold-start gaps become the column's mean."""
    return fill_with_mean(df, columns)


def hybrid_labels(df: DataFrame) -> DataFrame:
    """Adds ``y_label``: 1 for attended rows, the recommender's prediction otherwise."""
    return df.withColumn("y_label", hybrid_label(F.col("participated"), F.col("prediction")))


def levels(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a column that is to become columns."""
    found = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct()
             .limit(MAX_LEVELS + 1).collect()]
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{column} has over {MAX_LEVELS} values; use vocabulary and dummy_vectors")
    return sorted(found)


def dummy_columns(df: DataFrame, columns: list[str], domains: dict[str, list] | None = None) -> DataFrame:
    """0/1 columns ``<column>_<value>`` for all but the first value of each column."""
    domains = domains or {c: levels(df, c) for c in columns}
    flags = {f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
             for c in columns for v in domains[c][1:]}
    return df.withColumns(flags).drop(*columns)


def vocabulary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, place, size): the sorted values of each column as text, numbered from 0; stored.

    The table is data like any other: it is never collected, and later frames are encoded
    by it with the same places.
    """
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    found = df.select(F.inline(values)).filter("value IS NOT NULL").distinct()
    placed = cut_lineage(ranged_total(found, [F.col("column"), F.col("value")], F.lit(1)))
    starts = placed.groupBy("column").agg(F.min("before").alias("_start"), F.count(F.lit(1)).alias("size"))
    return cut_lineage(placed.join(F.broadcast(starts), "column").select(
        "column", "value", (F.col("before") - F.col("_start")).alias("place"), "size"))


def dummy_vectors(df: DataFrame, known: DataFrame) -> DataFrame:
    """``df`` with a sparse 0/1 vector ``<column>_dummies`` in place of each column of the vocabulary ``known``.

    Like ``dummy_columns`` without a limit on values: all but the first value have a place;
    the first value, missing and unknown ones are all zeros.
    """
    sizes = {r["column"]: r["size"] for r in known.groupBy("column").agg(F.max("size").alias("size")).collect()}
    for column, size in sizes.items():
        # the encoder drops the last category, so the first value becomes that
        places = known.filter(F.col("column") == column).select(
            F.col("value").alias("_value"), F.pmod(F.col("place") - 1, F.col("size")).cast("double").alias("_place"))
        if size == 1:
            df = df.withColumn(f"{column}_dummies", array_to_vector(F.array(F.lit(0.0))))
        else:
            coder = OneHotEncoder(inputCol="_place", outputCol=f"{column}_dummies").fit(places)
            joined = df.withColumn("_text", F.col(column).cast("string")).join(
                places, F.col("_text") == F.col("_value"), "left")
            df = coder.transform(joined.withColumn("_place", F.coalesce("_place", F.lit(float(size - 1)))))
        df = df.drop(column, "_text", "_value", "_place")
    return df


def vector_size(column: str) -> Column:
    """Length of a sparse vector column."""
    return F.get_json_object(F.to_json(F.struct(unwrap_udt(F.col(column)).alias("v"))), "$.v.size").cast("long")


def vector_place(column: str) -> Column:
    """Index at which a sparse vector column is set, null where it is all zeros."""
    return F.get_json_object(F.to_json(F.struct(unwrap_udt(F.col(column)).alias("v"))), "$.v.indices[0]").cast("long")


def align_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Exactly the wanted columns; those that are missing are 0."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in wanted])


# -- boosted trees ---------------------------------------------------------

def gbt_fit(rows: DataFrame, columns: list[str] = PREDICTIONS, label: str = "participated",
            variant: tuple[float, int, int, float] = fv.BOOSTING_VARIANTS[fv.BOOSTING_FINAL],
            seed: int = SEED) -> PipelineModel:
    """Boosted regression; ``variant`` is (learning rate, depth, trees, subsample).

    Fitted on kinds of rows, equal bins and label, in one task; rows of very many kinds,
    as with a label that is hardly ever the same, go to Spark's own fit.
    """
    return _fit_on(rows, boosting.kinds_of(rows, columns, label), label, variant, seed)


def _fit_on(rows: DataFrame, kinds: boosting.Kinds, label: str, variant: tuple[float, int, int, float],
            seed: int) -> PipelineModel:
    rate, depth, trees, subsample = variant
    assembler = VectorAssembler(inputCols=kinds.columns, outputCol="_features")
    regressor = GBTRegressor(featuresCol="_features", labelCol="_label", predictionCol="prediction",
                             stepSize=rate, maxDepth=depth, maxIter=trees, subsamplingRate=subsample,
                             seed=seed)
    if not kinds.few:
        ready = rows.select(*kinds.columns, F.col(label).cast("double").alias("_label"))
        return Pipeline(stages=[assembler, regressor]).fit(ready)
    return PipelineModel([assembler, boosting.fit_kinds(kinds, regressor)])


def gbt_predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows.drop("prediction")).drop("_features")


def gbt_predict_rank(model: PipelineModel, rows: DataFrame, item: str = "event_id") -> DataFrame:
    """One row: ``rank_bar`` and ``popularity_rank_bar`` of the model on ``rows``."""
    return _ranks(gbt_predict(model, rows), item)


def _ranks(scored: DataFrame, item: str) -> DataFrame:
    popular = popularity_rank_bar(scored, item).scalar()
    return rank_bar(scored).withColumn("popularity_rank_bar", popular)


def feature_importance(model: PipelineModel, columns: list[str] = PREDICTIONS) -> DataFrame:
    """Importance per input column."""
    values = model.stages[-1].featureImportances.toArray()
    return SparkSession.active().createDataFrame(
        [(c, float(v)) for c, v in zip(columns, values)], "feature string, importance double")


def first_trees(model: PipelineModel, trees: int) -> PipelineModel:
    """The same model stopped after ``trees`` trees.

    Boosting adds one tree after the other and each tree's sample depends on the seed and
    its number alone, so this is the model that a fit of fewer trees gives.
    """
    fitted = model.stages[-1]
    gateway = SparkSession.active().sparkContext._gateway
    spark_ml = gateway.jvm.org.apache.spark.ml.regression
    kept = gateway.new_array(spark_ml.DecisionTreeRegressionModel, trees)
    weights = gateway.new_array(gateway.jvm.double, trees)
    every = fitted._java_obj.trees()
    for i in range(trees):
        kept[i], weights[i] = every[i], float(fitted.treeWeights[i])
    made = GBTRegressionModel(spark_ml.GBTRegressionModel(fitted.uid, kept, weights, fitted.numFeatures))
    made.setFeaturesCol(fitted.getFeaturesCol()).setPredictionCol(fitted.getPredictionCol())
    return PipelineModel([*model.stages[:-1], made])


def compare_variants(train: DataFrame, validate: DataFrame, variants: dict[str, tuple] = fv.BOOSTING_VARIANTS,
                     columns: list[str] = PREDICTIONS, seed: int = SEED, parallelism: int = 4) -> DataFrame:
    """Ledger of parameter sets with their validation ranks, in the order of ``variants``.

    Sets that differ in the number of trees only come from one fit, each scored after its
    own number. All fits share the kinds of the training rows. Validation rows of equal bins
    have equal scores, so trees are walked once per kind of row. ``parallelism`` fits run at a
    time; only scores come to the driver.
    """
    fits: dict[tuple, list[str]] = {}
    for name, (rate, depth, _, subsample) in variants.items():
        fits.setdefault((rate, depth, subsample), []).append(name)
    kinds = boosting.kinds_of(train, columns, "participated")
    places = [boosting.bin_column(c) for c in columns]
    rows = boosting.binned(validate.drop("prediction"), columns, kinds.thresholds)
    # any values of a bin stand for it
    samples = cut_lineage(rows.groupBy(*places).agg(*[F.min(c).alias(c) for c in columns]))

    def score(model: PipelineModel):
        if not kinds.few:
            return gbt_predict_rank(model, validate).first()
        scored = cut_lineage(gbt_predict(model, samples).select(*places, "prediction"))
        return _ranks(rows.join(scored, places), "event_id").first()

    def one(fit: tuple) -> dict[str, tuple]:
        rate, depth, subsample = fit
        most = max(variants[name][2] for name in fits[fit])
        model = _fit_on(train, kinds, "participated", (rate, depth, most, subsample), seed)
        return {name: score(first_trees(model, variants[name][2])) for name in fits[fit]}

    # the longest fits first
    order = sorted(fits, key=lambda f: -f[1] * max(variants[name][2] for name in fits[f]))
    with ThreadPool(parallelism) as pool:
        scores = {name: score for found in pool.map(one, order, chunksize=1) for name, score in found.items()}
    rows = [(name, "val", float(rate), float(depth), float(trees), float(subsample),
             scores[name]["rank_bar"], scores[name]["popularity_rank_bar"])
            for name, (rate, depth, trees, subsample) in variants.items()]
    return train.sparkSession.createDataFrame(rows, BOOSTING_LEDGER)


def gbt_variants(train: DataFrame, validate: DataFrame, variants: dict[str, tuple] = fv.BOOSTING_VARIANTS,
                 columns: list[str] = PREDICTIONS, seed: int = SEED) -> tuple[DataFrame, str, PipelineModel]:
    """Compare parameter sets by validation rank and refit the best on all rows.

    Returns the ledger, the name of the best set and the refitted model.
    """
    ledger = compare_variants(train, validate, variants, columns, seed)
    best = best_variant(ledger)
    final = gbt_fit(train.unionByName(validate), columns, variant=variants[best], seed=seed)
    return ledger, best, final


def best_variant(ledger: DataFrame) -> str:
    """The set of the smallest rank; ties go by name."""
    return ledger.orderBy("model_rank", "gb_model").first()["gb_model"]


# -- content model ---------------------------------------------------------

CONTENT_CATEGORIES = ["series_id", "event_type_id", "venue_zip", "gender"]
CONTENT_NUMBERS = ["total_fee_avg", "miles_avg", "age_avg", "event_day"]


def content_rows(cells: DataFrame, users: DataFrame, predictions: DataFrame | None = None,
                 predicted: bool = False) -> DataFrame:
    """Event and person features with ``y_label``.

    With predictions the label is hybrid, without it is the attendance. ``predicted`` takes
    the cells' own ``prediction`` for it, without joining the cells to themselves.
    """
    rows = attach_user_features(cells, users).withColumn(
        "event_day", F.datediff("event_date", F.lit("1970-01-01").cast("date")))
    if predicted:
        return hybrid_labels(rows).drop("prediction")
    if predictions is None:
        return rows.withColumn("y_label", F.col("participated").cast("double"))
    return hybrid_labels(merge_labels_predictions(rows, predictions)).drop("prediction")


def content_gbt(rows: DataFrame, variant: tuple = (0.1, 3, 100, 1.0), seed: int = SEED) -> PipelineModel:
    """Boosted regression on one-hot categories and numbers.

    The fitted encoders hold the vocabulary, so later frames get the same columns;
    values unseen in training fall into a bucket of their own. A missing number is 0 and
    flagged in a column of its own, so every row is trained on and scored.

    Rows of equal features are one row with their mean label and their number as weight
    where no tree takes a sample of the rows: squared errors differ by a constant, so splits
    and leaves are the same. There are as many as events times kinds of people, not people.
    """
    rate, depth, trees, subsample = variant
    ready = _as_text(rows).filter(F.col("y_label").isNotNull())
    if subsample == 1.0:
        features = [f"_{c}_text" for c in CONTENT_CATEGORIES] + [
            f"_{c}_{part}" for c in CONTENT_NUMBERS for part in ("value", "missing")]
        ready = ready.groupBy(*features).agg(
            F.avg("y_label").alias("y_label"), F.count(F.lit(1)).cast("double").alias("_weight"))
    else:
        ready = ready.withColumn("_weight", F.lit(1.0))
    # stored, as encoders and trees read it several times
    ready = cut_lineage(ready)
    texts = [f"_{c}_text" for c in CONTENT_CATEGORIES]
    indexed = [f"_{c}_index" for c in CONTENT_CATEGORIES]
    encoded = [f"_{c}_vector" for c in CONTENT_CATEGORIES]
    stages = [
        StringIndexer(inputCols=texts, outputCols=indexed, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=encoded + [f"_{c}_{part}" for c in CONTENT_NUMBERS for part in ("value", "missing")],
                        outputCol="_features", handleInvalid="error"),
        GBTRegressor(featuresCol="_features", labelCol="y_label", predictionCol="prediction", weightCol="_weight",
                     stepSize=rate, maxDepth=depth, maxIter=trees, subsamplingRate=subsample,
                     seed=seed),
    ]
    return Pipeline(stages=stages).fit(ready)


def _as_text(rows: DataFrame) -> DataFrame:
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    return rows.withColumns(
        {f"_{c}_text": F.col(c).cast("string") for c in CONTENT_CATEGORIES}
        | {f"_{c}_value": F.coalesce(number(c), F.lit(0.0)) for c in CONTENT_NUMBERS}
        | {f"_{c}_missing": number(c).isNull().cast("double") for c in CONTENT_NUMBERS})


def content_predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Scored rows without the helper columns."""
    scored = model.transform(_as_text(rows.drop("prediction")))
    return scored.drop(*[c for c in scored.columns if c.startswith("_")])
