"""Positional splits by time.

Rows are ordered by (event_date, event_id, person_id) and cut at row counts. The
order of whole events follows from the event table and its row counts alone; at
most one event per cut lies on both sides, and for that one the last person
before the cut is looked up. Labelling a row is then a comparison on the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnout import fixed_values as fv
from turnout.operators.grid import Grid
from turnout.operators.position import nth_ids, null_safe_join, running_total
from turnout.session import cut_lineage

# share of rows to keep before the cut, applied to the part before the previous cut
Cuts = dict[str, float]


def standard_cuts(test: float = fv.TEST_SHARE, validation: float = fv.VALIDATION_SHARE) -> Cuts:
    """First the test rows are cut off, then the validation rows of what is left."""
    return {"test": 1 - test, "validate": 1 - validation}


def cut_events(sizes: DataFrame, cuts: Cuts, by: str | None = None) -> DataFrame:
    """Adds per cut ``<label>_quota``: how many of the event's rows lie before the cut.

    ``sizes``: event_id, event_date, n_rows (and ``by``). ``by`` cuts each of its
    values separately.
    """
    within = [by] if by else []
    totals = sizes.groupBy(*within).agg(F.sum("n_rows").alias("_all"))
    placed = running_total(sizes, "event_date", ["event_id"], F.col("n_rows"), within)
    if by:
        placed = null_safe_join(placed, totals, [by])
    else:
        placed = placed.withColumn("_all", totals.scalar())
    kept = F.col("_all")
    for label, share in cuts.items():
        kept = F.round(kept * F.lit(share)).cast("long")
        placed = placed.withColumn(
            f"{label}_quota",
            F.least(F.greatest(kept - F.col("before"), F.lit(0)), F.col("n_rows")))
    return placed.drop("before", "_all")


# bounds for events that lie on one side of a cut as a whole
NOBODY, EVERYBODY = -(2**63), 2**63 - 1


def _on_boundary(label: str) -> Column:
    quota = F.col(f"{label}_quota")
    return (quota > 0) & (quota < F.col("n_rows"))


def _wanted(quotas: DataFrame, cuts: Cuts, key: str = "event_id") -> DataFrame:
    """Key and quota for every cut that runs through an event."""
    through = F.array_compact(F.array(*[
        F.when(_on_boundary(label), F.col(f"{label}_quota")) for label in cuts]))
    return quotas.select(key, F.explode(through).alias("quota")).distinct()


def _bounds(quotas: DataFrame, cuts: Cuts) -> DataFrame:
    """Quotas and boundary ids to ``<label>_upto``: the last person before the cut."""
    for label in cuts:
        quota = F.col(f"{label}_quota")
        upto = (F.when(quota <= 0, F.lit(NOBODY))
                .when(quota >= F.col("n_rows"), F.lit(EVERYBODY))
                .otherwise(F.col(f"{label}_last")))
        quotas = quotas.withColumn(f"{label}_upto", upto).drop(f"{label}_quota", f"{label}_last")
    return quotas.drop("n_rows")


def bound_columns(cuts: Cuts) -> list[str]:
    return [f"{label}_upto" for label in cuts]


def split_label(cuts: Cuts, first: str = "train") -> Column:
    """Split of a row from its event's bounds; the cuts nest, the last one is innermost."""
    result = F.lit(first)
    for label in reversed(cuts):
        result = F.when(F.col("person_id") <= F.col(f"{label}_upto"), result).otherwise(F.lit(label))
    return result


def split_range(cuts: Cuts, split: str, first: str = "train") -> tuple[Column, Column]:
    """Of an event's people, those above the first and up to the second id are in ``split``."""
    labels = list(cuts)
    outer = labels[labels.index(split) - 1] if split in labels and labels.index(split) else None
    if split == first:
        outer = labels[-1]
    low = F.col(f"{split}_upto") if split in labels else F.lit(NOBODY)
    high = F.col(f"{outer}_upto") if outer else F.lit(EVERYBODY)
    return low, high


def split_grid(grid: Grid, cuts: Cuts | None = None, by: str | None = None) -> Grid:
    """The grid with the bounds of each cut on its events.

    All events of the grid have one row per person, so quotas need only the number
    of people, and boundaries only the order of people.
    """
    cuts = cuts or standard_cuts()
    n_people = grid.ids.agg(F.count(F.lit(1))).scalar()
    quotas = cut_events(grid.events.withColumn("n_rows", n_people), cuts, by)
    wanted = _wanted(quotas, cuts).select(F.lit(0).alias("_all"), "quota").distinct()
    members = grid.ids.select(F.lit(0).alias("_all"), "person_id", F.lit(1).alias("n"))
    last = nth_ids(members, wanted, "_all", "person_id")
    for label in cuts:
        quotas = quotas.join(
            last.select(F.col("quota").alias(f"{label}_quota"),
                        F.col("boundary_id").alias(f"{label}_last")), f"{label}_quota", "left")
    return grid.with_events(_bounds(quotas, cuts))


def split_cells(grid: Grid, cuts: Cuts | None = None, by: str | None = None,
                first: str = "train") -> DataFrame:
    """The grid with a ``split`` column."""
    cuts = cuts or standard_cuts()
    extra = bound_columns(cuts)
    cells = split_grid(grid, cuts, by).cells(*extra)
    return cells.withColumn("split", split_label(cuts, first)).drop(*extra)


def split_rows(rows: DataFrame, cuts: Cuts | None = None, by: str | None = None,
               first: str = "train") -> DataFrame:
    """Any frame of persons and events with a ``split`` column.

    ``rows`` is read for the event sizes, for the people of events on a boundary and
    for the labels; hand in a stored frame if it is costly. Every row is labelled once:
    an event with several dates is cut date by date, missing dates come last, a missing
    value of ``by`` is a value of its own and missing people come last in their event.
    Where a person has several rows at an event on a cut, the cut goes through them.
    """
    cuts = cuts or standard_cuts()
    within = [by] if by else []
    spot = F.struct("event_id", "event_date", *within)
    keyed = rows.withColumns({"_spot": spot, "_person": F.coalesce("person_id", F.lit(EVERYBODY))})
    sizes = keyed.groupBy("_spot").agg(F.count(F.lit(1)).alias("n_rows")).select("_spot", "_spot.*", "n_rows")
    quotas = cut_lineage(cut_events(sizes, cuts, by))
    wanted = _wanted(quotas, cuts, "_spot")
    members = cut_lineage(
        keyed.join(wanted.select("_spot").distinct(), "_spot", "left_semi")
        .groupBy("_spot", "_person").agg(F.count(F.lit(1)).alias("n")))
    last = nth_ids(members, wanted, "_spot", "_person")
    for label in cuts:
        quotas = quotas.join(
            last.select("_spot", F.col("quota").alias(f"{label}_quota"), F.col("boundary_id").alias(f"{label}_last"),
                        F.col("boundary_rows").alias(f"{label}_keep")),
            ["_spot", f"{label}_quota"], "left")
    extra, keeps = bound_columns(cuts), [f"{label}_keep" for label in cuts]
    keys = cut_lineage(_bounds(quotas, cuts).select("_spot", *extra, *keeps))
    bounded = keyed.join(keys, "_spot")
    cut_people = F.lit(False)
    for label in cuts:
        cut_people = cut_people | (F.col(f"{label}_keep").isNotNull() & (F.col("_person") == F.col(f"{label}_upto")))
    order = [c for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    turn = W.partitionBy("_spot", "_person").orderBy(F.xxhash64(*order))
    bounded = bounded.where(~cut_people).withColumn("_turn", F.lit(0)).unionByName(
        bounded.where(cut_people).withColumn("_turn", F.row_number().over(turn)))
    label_of = F.lit(first)
    for label in reversed(cuts):
        upto, keep = F.col(f"{label}_upto"), F.col(f"{label}_keep")
        before = (F.col("_person") < upto) | ((F.col("_person") == upto) & (
            keep.isNull() | (F.col("_turn") <= keep)))
        label_of = F.when(before, label_of).otherwise(F.lit(label))
    return bounded.withColumn("split", label_of).select(*rows.columns, "split")


def ordered_cut(rows: DataFrame, share: float = 0.8) -> DataFrame:
    """First part of the rows by date as 'train', the rest as 'validate'."""
    return split_rows(rows, {"validate": share})


def append_parts(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for more in parts[1:]:
        result = result.unionByName(more)
    return result


def split_overlap_report(rows: DataFrame, keys: list[str], base: str = "train",
                         others: tuple[str, ...] = ("validate", "test")) -> DataFrame:
    """Distinct key values per split and shared with the base split, one row per key.

    All keys go through one pass; a row leaves the map side once per key at most,
    as partial aggregation has folded equal values before.
    """
    splits = (base, *others)
    values = F.array(*[
        F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
    present = rows.select("split", F.inline(values)).groupBy("key", "value").agg(
        *[F.max(F.col("split") == s).alias(s) for s in splits])
    return present.groupBy("key").agg(
        *[F.count_if(F.col(s)).alias(f"in_{s}") for s in splits],
        *[F.count_if(F.col(base) & F.col(s)).alias(f"in_{base}_and_{s}") for s in others])


def cold_start_report(rows: DataFrame, key: str, base: str = "train",
                      other: str = "validate") -> DataFrame:
    """Key values of one split that the base split lacks, and the rows this affects."""
    per_key = rows.groupBy(key).agg(
        F.count_if(F.col("split") == base).alias("_base"),
        F.count_if(F.col("split") == other).alias("_rows"))
    cold = per_key.filter("_base = 0 AND _rows > 0")
    return cold.agg(F.count(F.lit(1)).alias("cold_keys"),
                    F.coalesce(F.sum("_rows"), F.lit(0)).alias("cold_rows"))
