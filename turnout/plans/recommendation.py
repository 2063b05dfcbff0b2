"""Recommender run, boosted ensemble and audience."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from turnout import fixed_values as fv
from turnout.operators import als, ensemble
from turnout.operators.evaluate import popularity_rank_bar, rank_bar
from turnout.operators.grid import Grid, make_grid
from turnout.operators.recommend import top_event_counts, top_k_per_person
from turnout.operators.split import Cuts, ordered_cut, split_grid, standard_cuts
from turnout.schemas import ALS_FINAL_LEDGER, BOOSTING_LEDGER
from turnout.sources.models import save_als_model
from turnout.sources.tables import snapshot

TEST_CUT: Cuts = {"test": standard_cuts()["test"]}


def recommend_events(parts: DataFrame, item: str = "series_id", rank: int = 5,
                     alpha: float = 80.0, k: int = 5) -> DataFrame:
    """Grid, split by time, one recommender, top lists on the test rows, event counts."""
    cuts = standard_cuts()
    grid = split_grid(make_grid(parts), cuts)
    fitted = als.fit_recommender(grid, item, cuts, rank=rank, alpha=alpha)
    test = als.als_predict(grid, fitted).filter("split = 'test'")
    return top_event_counts(top_k_per_person(test, k))


@dataclass(frozen=True)
class EnsembleRun:
    grid: Grid
    recommenders: dict[str, als.Recommender]
    scored: DataFrame
    model: PipelineModel


def ensemble_frame(grid: Grid, fitted: dict[str, als.Recommender], path: str) -> DataFrame:
    """Five predictions per cell with their split, stored as parquet."""
    cells = als.score_cells(grid, fitted, TEST_CUT, "trainval")
    kept = cells.select("person_id", "event_id", "participated", "event_date", "split", *fitted)
    return snapshot(kept, path)


def run_ensemble(parts: DataFrame, path: str, by: str | None = "series_id",
                 variant: tuple | None = None) -> EnsembleRun:
    """Five recommenders on the rows before the test cut, and boosted trees on top.

    Models and the scored cells are stored below ``path``; a lost executor or a
    later step reads them from there.
    """
    grid = split_grid(make_grid(parts), TEST_CUT, by)
    fitted = {
        name: als.Recommender(save_als_model(r.model, f"{path}/{name}"), r.item, r.cuts, r.first,
                              r.trained_on)
        for name, r in als.fit_five(grid, TEST_CUT, "trainval", "trainval").items()
    }
    scored = ensemble_frame(grid, fitted, f"{path}/cells")
    trainval = ensemble.fill_prediction_mean(scored.filter("split = 'trainval'"))
    extra = {"variant": variant} if variant else {}
    return EnsembleRun(grid, fitted, scored, ensemble.gbt_fit(trainval, **extra))


def ensemble_top_lists(run: EnsembleRun, k: int = 5) -> DataFrame:
    """Top lists of the ensemble on the test rows."""
    test = ensemble.fill_prediction_mean(run.scored.filter("split = 'test'"))
    return top_k_per_person(ensemble.gbt_predict(run.model, test), k)


def train_validate(scored: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The rows before the test cut, filled and divided by date for choosing parameters."""
    filled = ensemble.fill_prediction_mean(scored.filter("split = 'trainval'").drop("split"))
    parts = ordered_cut(filled, share)
    return (parts.filter(F.col("split") == "train").drop("split"),
            parts.filter(F.col("split") == "validate").drop("split"))


def final_ledger(grid: Grid, fitted: dict[str, als.Recommender], splits: tuple[str, ...] = ("trainval", "test"),
                 alpha: float = fv.RECOMMENDER_ALPHA) -> DataFrame:
    """A row per model and split: its rank, the popularity list's rank and the cells it cannot score.

    Ranks come from people x distinct items and dropped cells from sums over events, so
    the grid is not spelled out.
    """
    rows = []
    for model in fitted.values():
        for split in splits:
            scores = als.rank_scores(grid, model, split).first()
            rows.append((model.item, split, float(alpha), model.rank, scores["rank_bar"],
                         scores["popularity_rank_bar"], als.cold_cells(grid, model, split)))
    return grid.ids.sparkSession.createDataFrame(rows, ALS_FINAL_LEDGER)


def naive_ranks(scored: DataFrame, splits: tuple[str, ...] = ("trainval", "test")) -> DataFrame:
    """Ledger rows of the plain ensembles: mean of all predictions, of the two smallest and the two largest.

    ``scored``: stored cells with ``split`` and the five predictions, gaps filled per split.
    """
    spark = scored.sparkSession
    kinds = {"mean": ensemble.mean_ensemble,
             "smallest": lambda df: ensemble.extreme_ensemble(df, which="smallest"),
             "largest": lambda df: ensemble.extreme_ensemble(df, which="largest")}
    rows = []
    for split in splits:
        filled = ensemble.fill_prediction_mean(scored.filter(F.col("split") == split))
        for name, combine in kinds.items():
            cells = combine(filled)
            rows.append((f"naive_{name}", split, None, None, None, None, rank_bar(cells).first()[0],
                         popularity_rank_bar(cells, "event_id").first()[0]))
    return spark.createDataFrame(rows, BOOSTING_LEDGER)
