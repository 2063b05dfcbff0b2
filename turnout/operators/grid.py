"""The person x event grid.

The grid is people times events rows, so nothing here shuffles, sorts or stores
it. What a cell needs is put on its person (events attended, factors) or on its
event (attributes, split quotas) beforehand; a cell is then computed where its
person's row lies. People stay partitioned by person_id, hence per-person
aggregates and top-k lists over the grid need no exchange either.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from turnout.operators.attendance import event_attributes
from turnout.session import cut_lineage

# An event row is nine numbers, under 100 bytes: this many are under 20 MB.
BROADCAST_EVENTS = 200_000

GRID_COLUMNS = ["person_id", "event_id", "participated", "event_date", "series_id",
                "event_type_id", "total_fee_avg", "miles_avg", "venue_zip"]


def person_baskets(parts: DataFrame) -> DataFrame:
    """Per person the distinct events attended (at most as many as there are events).

    The number of partitions is set: left to itself, adaptive execution would merge
    partitions that are small now, but each row is about to become one per event.
    """
    return (
        parts.select("person_id", "event_id").distinct()
        .repartition(grid_partitions(parts), "person_id")
        .groupBy("person_id").agg(F.collect_list("event_id").alias("attended"))
    )


def grid_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pair_up(people: DataFrame, items: DataFrame, n_items: int,
            broadcast_limit: int = BROADCAST_EVENTS, slots: int | None = None) -> DataFrame:
    """Every person with every item, as an equi-join on a slot.

    Up to ``broadcast_limit`` items (counted, not estimated) there is one slot: the
    items go to every task and the people rows do not move. Beyond that people are
    spread over ``slots`` and the items are repeated once per slot, so that each
    task pairs one slot of people with the items and Spark may sort-merge and spill.
    """
    small = n_items <= broadcast_limit
    slots = 1 if small else slots or grid_partitions(people)
    left = people.withColumn("_slot", F.pmod(F.hash("person_id"), F.lit(slots)))
    right = items.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return left.join(F.broadcast(right) if small else right, "_slot").drop("_slot")


def join_events(rows: DataFrame, events: DataFrame, n_events: int) -> DataFrame:
    """Rows with their event's columns; ``events`` is stored and was counted.

    Small event tables go to the rows. Larger ones are sort-merged, where an event
    with very many rows is split, as both sides come straight out of a shuffle.
    """
    small = n_events <= BROADCAST_EVENTS
    return rows.join(F.broadcast(events) if small else events, "event_id")


@dataclass(frozen=True)
class Grid:
    """People and events whose pairs are the grid; ``cells`` spells it out lazily.

    ids: person_id of everybody, once.
    people: person_id, attended, and what was attached to people.
    events: event table, stored, and what was attached to events.
    """

    ids: DataFrame
    people: DataFrame
    events: DataFrame
    n_events: int

    def cells(self, *keep: str) -> DataFrame:
        """The grid, with the attached columns named in ``keep``."""
        pairs = pair_up(self.people, self.events, self.n_events)
        flag = F.array_contains("attended", F.col("event_id")).cast("int")
        return pairs.withColumn("participated", flag).select(*GRID_COLUMNS, *keep)

    def with_people(self, people: DataFrame) -> Grid:
        return replace(self, people=people)

    def with_events(self, events: DataFrame) -> Grid:
        """Events with more columns; they are small and stored again."""
        return replace(self, events=cut_lineage(events))


def make_grid(parts: DataFrame, events: DataFrame | None = None, store: bool = True) -> Grid:
    """Grid of all people and events in ``parts``.

    ``events`` may bring an event table of its own; the default takes attributes
    and means from the participations. ``store`` writes the baskets once, for
    callers that use people several times (splits, fits, scores); they are a small
    fraction of the grid.
    """
    stored = cut_lineage(events if events is not None else event_attributes(parts))
    people = person_baskets(parts)
    ids = parts.select("person_id").distinct()
    if store:
        people = cut_lineage(people)
        ids = people.select("person_id")
        people = people.repartition(grid_partitions(parts), "person_id")
    return Grid(ids, people, stored, stored.count())


def participation_grid(parts: DataFrame, events: DataFrame | None = None) -> DataFrame:
    return make_grid(parts, events, store=False).cells()


def implicit_zeros(parts: DataFrame) -> DataFrame:
    """Pairs that did not happen."""
    return participation_grid(parts).filter("participated = 0")


def positives_only(parts: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Pairs that did happen, straight from the participations: no grid involved."""
    stored = cut_lineage(events if events is not None else event_attributes(parts))
    pairs = parts.select("person_id", "event_id").distinct()
    joined = join_events(pairs, stored, stored.count())
    return joined.withColumn("participated", F.lit(1)).select(*GRID_COLUMNS)


def als_matrix(cells: DataFrame, item: str) -> DataFrame:
    """The four columns a recommender is trained on."""
    return cells.select("person_id", item, "participated", "event_date")
