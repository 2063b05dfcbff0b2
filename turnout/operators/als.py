"""Recommenders on recurring event features.

Training reads attended pairs only: in implicit ALS a pair that did not happen
has no weight, so zeros of the grid would change nothing but the cost. Scoring
puts a person's factors on the person and an item's factors on its events, so a
grid cell's prediction is a dot product on the row; the two joins of
``ALSModel.transform`` over all cells are not needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnout import fixed_values as fv
from turnout.functions.scores import dot
from turnout.operators.evaluate import popularity_rank_bar, rank_bar
from turnout.operators.grid import GRID_COLUMNS, Grid, join_events, pair_up
from turnout.operators.position import dense_codes
from turnout.operators.split import (
    Cuts, bound_columns, split_label, split_range)
from turnout.session import cut_lineage

SEED = 20

# most items whose scores a person carries as a list
LISTED_ITEMS = 256


@dataclass(frozen=True)
class Folds:
    """Cells dealt to ``k`` folds: a cell's fold is the sum of its person's and its event's class.

    Every cell is in one fold, every person and every event has cells in all of them, and a
    fold is a union of ``k`` blocks of people times events, so that sums over it need no cells.
    """

    k: int
    seed: int = SEED

    def of(self, column: str) -> Column:
        """Class of a person or an event."""
        return F.pmod(F.xxhash64(F.lit(column), F.lit(self.seed), F.col(column).cast("long")), F.lit(self.k))

    def cell(self) -> Column:
        return F.pmod(self.of("person_id") + self.of("event_id"), F.lit(self.k))


@dataclass(frozen=True)
class CodedModel:
    """A model fitted on dense codes, and the dictionaries (id, code) of its people and items.

    Spark ML takes ids of 32 bits; the factors here carry the ids as they were.
    """

    model: ALSModel
    people: DataFrame
    items: DataFrame

    @property
    def rank(self) -> int:
        return self.model.rank

    @property
    def userFactors(self) -> DataFrame:
        return _decoded(self.model.userFactors, self.people)

    @property
    def itemFactors(self) -> DataFrame:
        return _decoded(self.model.itemFactors, self.items)


def _decoded(factors: DataFrame, codes: DataFrame) -> DataFrame:
    return factors.withColumnRenamed("id", "code").join(codes, "code").select("id", "features")


@dataclass(frozen=True)
class Recommender:
    """A fitted model, the grid column it takes as item, and the split it was trained on."""

    model: ALSModel | CodedModel
    item: str
    cuts: Cuts
    first: str = "train"
    trained_on: str = "train"

    @property
    def rank(self) -> int:
        return self.model.rank


def _int32(column: str) -> Column:
    """An id in 32 bits; an error in any mode, never another id, if it does not fit."""
    fits = F.col(column).isNull() | F.col(column).between(-2**31, 2**31 - 1)
    return F.when(fits, F.col(column)).otherwise(
        F.raise_error(F.lit(f"{column} does not fit 32 bits"))).cast("int")


def _beyond_32_bits(rows: DataFrame, *columns: str) -> bool:
    outside = [~F.col(c).between(-2**31, 2**31 - 1) for c in columns]
    return any(rows.agg(*[F.coalesce(F.bool_or(x), F.lit(False)) for x in outside]).first())


def als_fit(rows: DataFrame, item: str, rank: int = 100, max_iter: int = 10, reg: float = 0.1,
            alpha: float = 1.0, implicit: bool = True, nonnegative: bool = True,
            seed: int = SEED, person: str = "person_id", rating: str = "participated",
            dedupe: str | None = None, person_blocks: int | None = None,
            item_blocks: int | None = None) -> ALSModel | CodedModel:
    """Fit one model. Several events with the same item value are separate observations;
    ``dedupe='sum'`` adds them up instead.

    People are laid out in as many blocks as the cluster has cores, since a block has to
    fit a task's memory. Items are few; they get at most ten blocks. Spark ML asks for
    ids of 32 bits. Where an id is larger, people and items are fitted by dense codes,
    and the factors of the ``CodedModel`` carry the ids again; that takes up to 2^31
    distinct people and as many items.
    """
    person_blocks = person_blocks or rows.sparkSession.sparkContext.defaultParallelism
    item_blocks = item_blocks or min(person_blocks, 10)
    ready = rows.select(person, item, F.col(rating).cast("float").alias(rating))
    people = items = None
    if _beyond_32_bits(ready, person, item):
        people, items = dense_codes(ready, person), dense_codes(ready, item)
        ready = (
            ready.join(people.select(F.col("id").alias(person), F.col("code").alias("_person")), person)
            .join(items.select(F.col("id").alias(item), F.col("code").alias("_item")), item)
            .select(F.col("_person").alias(person), F.col("_item").alias(item), rating))
    ready = ready.withColumns({person: _int32(person), item: _int32(item)})
    if dedupe == "sum":
        ready = ready.groupBy(person, item).agg(F.sum(rating).cast("float").alias(rating))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol=person, itemCol=item,
              ratingCol=rating, nonnegative=nonnegative, implicitPrefs=implicit, alpha=alpha,
              coldStartStrategy="drop", seed=seed, numUserBlocks=person_blocks,
              numItemBlocks=item_blocks)
    model = als.fit(ready)
    return CodedModel(model, people, items) if people is not None else model


def als_fit_implicit(rows: DataFrame, item: str, **params) -> ALSModel | CodedModel:
    return als_fit(rows.filter("participated > 0"), item, implicit=True, **params)


def als_fit_explicit(rows: DataFrame, item: str, **params) -> ALSModel | CodedModel:
    """Baseline that takes attendance as a rating; sees attended pairs only."""
    return als_fit(rows.filter("participated > 0"), item, implicit=False, **params)


def attended_cells(grid: Grid, cuts: Cuts, first: str = "train") -> DataFrame:
    """Attended cells of a split grid with their ``split``, without spelling out the grid."""
    pairs = grid.people.select("person_id", F.explode("attended").alias("event_id"))
    joined = join_events(pairs, grid.events, grid.n_events).withColumn("participated", F.lit(1))
    return joined.withColumn("split", split_label(cuts, first)).select(*GRID_COLUMNS, "split")


def fit_recommender(grid: Grid, item: str, cuts: Cuts, first: str = "train",
                    train_on: str = "train", **params) -> Recommender:
    """Fit on the attended cells of one split of a split grid."""
    rows = attended_cells(grid, cuts, first).filter(F.col("split") == train_on)
    return Recommender(als_fit_implicit(rows, item, **params), item, cuts, first, train_on)


def _user_factors(model: ALSModel | CodedModel, name: str) -> DataFrame:
    return model.userFactors.select(
        F.col("id").cast("long").alias("person_id"), F.col("features").alias(name))


def _item_table(events: DataFrame, fitted: Recommender, name: str) -> DataFrame:
    """Items of the training split with their factors; zeros if nobody took part."""
    low, high = split_range(fitted.cuts, fitted.trained_on, fitted.first)
    seen = events.filter(low < high).select(fitted.item).distinct()
    factors = fitted.model.itemFactors.select(
        F.col("id").alias(fitted.item), F.col("features").alias(name))
    zeros = F.array_repeat(F.lit(0.0).cast("float"), fitted.rank)
    return seen.join(factors, fitted.item, "left").withColumn(name, F.coalesce(name, zeros))


def _score(user: str, item: str, rank: int) -> Column:
    """NULL for an item outside training, 0 for a person without factors."""
    product = dot(F.col(user), F.col(item), rank)
    return F.when(F.col(item).isNotNull(), F.coalesce(product, F.lit(0.0)))


def _listed(grid: Grid, model: Recommender, name: str) -> Grid | None:
    """``<name>_scores`` on people, a score per item, and ``<name>_place`` on events, the item's place in it.

    None where a list would save nothing, as most events have an item of their own.
    """
    items = cut_lineage(_item_table(grid.events, model, "_item"))
    if items.count() > min(LISTED_ITEMS, grid.n_events // 2):
        return None
    lists = cut_lineage(items.agg(F.sort_array(F.collect_list(F.struct(model.item, "_item"))).alias("_items")))
    places = lists.select(F.posexplode("_items").alias(f"{name}_place", "_entry")).select(
        f"{name}_place", F.col(f"_entry.{model.item}").alias(model.item))
    user = F.col("_user")
    scores = F.transform("_items", lambda i: F.coalesce(dot(user, i["_item"], model.rank), F.lit(0.0)))
    people = grid.people.join(_user_factors(model.model, "_user"), "person_id", "left").join(
        F.broadcast(lists)).withColumn(f"{name}_scores", scores).drop("_user", "_items")
    return grid.with_people(people).with_events(grid.events.join(places, model.item, "left"))


def attach(grid: Grid, fitted: dict[str, Recommender]) -> tuple[Grid, dict[str, Column], list[str]]:
    """The grid with what scores need on people and events, the score of each model on a cell, the columns used.

    Events that share an item share its score. Where items are few next to events a person's
    scores are computed once per item, not once per cell; the products of all models in one
    cell are also more code than the JVM compiles.
    """
    scores, extra = {}, []
    for name, model in fitted.items():
        listed = _listed(grid, model, name)
        if listed is not None:
            grid = listed
            scores[name] = F.get(f"{name}_scores", F.col(f"{name}_place"))
            extra += [f"{name}_scores", f"{name}_place"]
        else:
            user, item = f"{name}_user", f"{name}_item"
            grid = grid.with_people(
                grid.people.join(_user_factors(model.model, user), "person_id", "left")).with_events(
                grid.events.join(_item_table(grid.events, model, item), model.item, "left"))
            scores[name] = _score(user, item, model.rank)
            extra += [user, item]
    return grid, scores, extra


def score_cells(grid: Grid, fitted: dict[str, Recommender], cuts: Cuts,
                first: str = "train") -> DataFrame:
    """Grid cells with ``split`` and one prediction column per model, named as in ``fitted``."""
    ready, scores, extra = attach(grid, fitted)
    extra = extra + bound_columns(cuts)
    cells = ready.cells(*extra).withColumn("split", split_label(cuts, first))
    return cells.withColumns(scores).drop(*extra)


def als_predict(grid: Grid, fitted: Recommender, drop_cold: bool = True) -> DataFrame:
    """Grid cells with ``split`` and ``prediction``.

    Persons and items of the training split are scored even if they have no factors
    (0, as dense training gives them); items outside it are cold and are dropped.
    """
    scored = score_cells(grid, {"prediction": fitted}, fitted.cuts, fitted.first)
    return scored.filter(F.col("prediction").isNotNull()) if drop_cold else scored


def prediction_counts(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Valid and missing predictions per split."""
    missing = F.col(prediction).isNull() | F.isnan(prediction)
    return scored.groupBy("split").agg(
        F.count_if(~missing).alias("valid"), F.count_if(missing).alias("missing"))


def item_scores(grid: Grid, fitted: Recommender, split: str, folds: Folds | None = None,
                fold: int | None = None) -> DataFrame:
    """person_id, item, participated, prediction for one split, a row per person and item.

    All events with the same item value have the same score, so people x items is
    enough for ``rank_bar``; ``participated`` counts the attended events. An item
    belongs to a person's rows if one of its events lies in the split for that
    person, which the ranges say for events on a boundary, and in ``fold``, if given.
    """
    low, high = split_range(fitted.cuts, split, fitted.first)
    attended = attended_cells(grid, fitted.cuts, fitted.first).filter(F.col("split") == split)
    wanted = F.lit(0).cast("long")  # class of the events a person meets
    event_class = F.lit(0).cast("long")
    if folds:
        attended = attended.filter(folds.cell() == fold)
        wanted = F.pmod(F.lit(fold) - folds.of("person_id"), F.lit(folds.k))
        event_class = folds.of("event_id")
    counts = (
        attended.groupBy("person_id", fitted.item).agg(F.count(F.lit(1)).alias("n"))
        .groupBy("person_id")
        .agg(F.map_from_entries(F.collect_list(F.struct(fitted.item, "n"))).alias("_counts"))
    )
    people = (
        grid.ids.join(counts, "person_id", "left")
        .join(_user_factors(fitted.model, "_user"), "person_id", "left")
    )
    items = cut_lineage(
        grid.events.withColumns({"_low": low, "_high": high, "_class": event_class}).filter("_low < _high")
        .groupBy(fitted.item).agg(F.collect_set(F.struct("_low", "_high", "_class")).alias("_ranges"))
        .join(_item_table(grid.events, fitted, "_item"), fitted.item))
    here = F.exists("_ranges", lambda r: (F.col("person_id") > r["_low"])
                    & (F.col("person_id") <= r["_high"]) & (r["_class"] == wanted))
    return pair_up(people, items, items.count()).filter(here).select(
        "person_id", fitted.item,
        F.coalesce(F.col("_counts")[F.col(fitted.item)], F.lit(0)).alias("participated"),
        _score("_user", "_item", fitted.rank).alias("prediction"))


def cold_cells(grid: Grid, fitted: Recommender, split: str) -> int:
    """How many cells of a split have an item that the model's training rows lack.

    People are counted once per range of ids that such an event has in the split.
    """
    low, high = split_range(fitted.cuts, split, fitted.first)
    known = _item_table(grid.events, fitted, "_item").select(fitted.item)
    cold = cut_lineage(grid.events.withColumns({"_low": low, "_high": high}).filter("_low < _high").join(
        known, fitted.item, "left_anti").groupBy("_low", "_high").agg(F.count(F.lit(1)).alias("_events")))
    inside = (F.col("person_id") > F.col("_low")) & (F.col("person_id") <= F.col("_high"))
    found = grid.ids.join(F.broadcast(cold), inside).agg(F.sum("_events")).first()[0]
    return int(found or 0)


def rank_scores(grid: Grid, fitted: Recommender, split: str) -> DataFrame:
    """One row: ``rank_bar`` and ``popularity_rank_bar`` of a model on one split."""
    scored = item_scores(grid, fitted, split)
    popular = popularity_rank_bar(scored, fitted.item).scalar()
    return rank_bar(scored).withColumn("popularity_rank_bar", popular)


def fit_five(grid: Grid, cuts: Cuts, first: str = "train", train_on: str = "train",
             ranks: dict[str, int] = fv.RECOMMENDER_RANKS, alpha: float = fv.RECOMMENDER_ALPHA,
             seed: int = SEED) -> dict[str, Recommender]:
    """The five final recommenders, keyed ``<item>_prediction``.

    Attended cells are stored once for all fits.
    """
    rows = attended_cells(grid, cuts, first).filter(F.col("split") == train_on).persist()
    try:
        return {
            f"{item}_prediction": Recommender(
                als_fit_implicit(rows, item, rank=rank, alpha=alpha, seed=seed),
                item, cuts, first, train_on)
            for item, rank in ranks.items()
        }
    finally:
        rows.unpersist()


def factor_exploration(model: ALSModel | CodedModel, side: str = "item", top: int = 3) -> DataFrame:
    """Per latent factor the ids that load on it most."""
    factors = model.itemFactors if side == "item" else model.userFactors
    loads = factors.select("id", F.posexplode("features").alias("factor", "loading"))
    order = W.partitionBy("factor").orderBy(F.desc("loading"), "id")
    return loads.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
