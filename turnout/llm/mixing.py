"""Mixing sources to target weights.

Source weights are token shares raised to an exponent between 0 (uniform) and 1
(natural). The exponent is bisected to meet a target entropy or a limit on how
often a source may repeat. A budget is then dealt out by weights and realised
as block permutations: every epoch visits the blocks of a source in another
hashed order and stops where the source's budget is used up.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from turnout.llm.common import stored, table, text_of
from turnout.llm.registry import query

STEPS = 4
ROUNDS = 6
#: Hex digits of a range of block hashes: 4,096 ranges per source and epoch.
RANGE = 3


@dataclass(frozen=True)
class Mix:
    """``entropy``: target as a part of the largest possible; ``repeats``: most epochs of any source,
    which wins over the entropy; ``budget``: tokens, None for one whole epoch of the source that
    repeats least, so that no document is left out; ``block_tokens``: aimed size of a block."""

    entropy: float = 0.95
    repeats: float = 2.0
    budget: int | None = None
    block_tokens: int = 200_000
    seed: int = 7


def count_tokens(text: Column) -> Column:
    """Words between blanks, tabs and line breaks; 1 at least."""
    return F.greatest(F.regexp_count(text, F.lit("[^ \\t\\r\\n]+")).cast("long"), F.lit(1))


def _unit(*parts: Column | str) -> Column:
    """A hash as 16 hex digits, the same in any engine with MD5."""
    return F.substring(F.md5(F.concat_ws(":", *parts)), 1, 16)


def solve_exponent(totals: DataFrame, mix: Mix) -> float | None:
    """The exponent for sources with ``tokens``; only sums over sources reach the driver.

    Entropy falls and the largest repetition falls as the exponent rises, so
    each condition is bisected alone and the larger exponent holds. One job
    halves an interval ``STEPS`` times by trying all its inner points.
    """
    whole = totals.agg(F.sum("tokens").alias("t"), F.count("tokens").alias("k")).first()
    if not whole["k"]:
        return None
    whole_tokens, sources = float(whole["t"]), whole["k"]
    parts = totals.select((F.col("tokens") / whole_tokens).alias("p"))

    def holds(points: list[float]) -> list[tuple[bool, bool]]:
        sums: list[Column] = []
        for i, a in enumerate(points):
            power = F.pow("p", F.lit(a))
            sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log("p")).alias(f"l{i}"),
                     F.max(power / F.col("p")).alias(f"m{i}"), F.min(power / F.col("p")).alias(f"n{i}")]
        row = parts.agg(*sums).first()
        found = []
        for i, a in enumerate(points):
            z = row[f"z{i}"]
            entropy = math.log(z) - a * row[f"l{i}"] / z
            limit = math.log(sources) * mix.entropy
            epochs = (row[f"m{i}"] / row[f"n{i}"] if mix.budget is None
                      else row[f"m{i}"] / z * mix.budget / whole_tokens)
            found.append((round(entropy, 9) <= round(limit, 9), round(epochs, 9) <= mix.repeats))
        return found

    solved = []
    for condition in (0, 1):
        low, high = 0.0, 1.0
        first = holds([0.0])[0][condition]
        if first:
            solved.append(0.0)
            continue
        for _ in range(ROUNDS):
            n = 2 ** STEPS
            points = [low + (high - low) * i / n for i in range(1, n)]
            met = [x[condition] for x in holds(points)]
            at = met.index(True) if True in met else n - 1
            low, high = low + (high - low) * at / n, low + (high - low) * (at + 1) / n
        solved.append(round(high, 6))
    return max(solved)


def source_plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """Per source: tokens, weight, target tokens and number of blocks."""
    totals = stored(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-totals")
    exponent = solve_exponent(totals, mix)
    power = totals.withColumn("power", F.pow(F.col("tokens").cast("double"), F.lit(exponent or 0.0)))
    sums = power.agg(F.sum("power").alias("z"), F.max(F.col("tokens") / F.col("power")).alias("most"))
    weight = F.round(F.col("power") / F.col("z"), 9)
    budget = (F.ceil(F.round(F.col("most") * F.col("z"), 3)) if mix.budget is None else F.lit(mix.budget))
    return power.join(F.broadcast(sums)).select(
        "source", "tokens", weight.alias("weight"),
        F.greatest(F.ceil(F.round(weight * budget, 3)).cast("long"),
                   F.when(F.lit(mix.budget is None), F.col("tokens")).otherwise(F.lit(0))).alias("target"),
        F.greatest(F.ceil(F.col("tokens") / mix.block_tokens), F.lit(1)).cast("long").alias("blocks"))


def mix_sources(docs: DataFrame, mix: Mix = Mix(), keep: list[str] | None = None) -> DataFrame:
    """One row per realised copy: ``row`` (the document's columns), source, tokens, weight, epoch,
    block and start (tokens of the source that come before the copy).

    Needs doc_id, text and source; the columns ``keep`` (None: all) travel inside
    ``row`` and may have any name. A null source counts as the source named ''. A null text is
    an empty one, and an empty text counts one token. Copies are taken in order
    of start until the target is reached, so a source goes over it by less than
    one document. Rows that repeat a document are separate rows; an order among
    equal ones shows nowhere. An empty table gives no rows.

    Only documents' blocks need one shuffle; the order within a block is fixed,
    the order of blocks changes with each epoch. A block has about
    ``block_tokens`` tokens whatever its source's share, so a hot source is
    spread over many.
    """
    rows = docs.select(
        F.struct(*(keep or docs.columns)).alias("row"), F.coalesce("source", F.lit("")).alias("source"),
        count_tokens(text_of()).alias("tokens"), F.hash("text").alias("tie"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"))
    slim = stored(rows.select("source", "tokens", "key"), "mix-sizes")
    plan = stored(source_plan(slim, mix), "mix-plan")
    number = F.conv(F.substring(_unit(F.lit(str(mix.seed)), "key"), 1, 12), 16, 10).cast("long")
    number = F.pmod(number, F.col("blocks")).alias("block")
    dealt = rows.join(plan.select("source", "blocks"), "source").select(
        "row", "source", "tokens", "key", "tie", number)

    block_sums = stored(slim.join(plan.select("source", "blocks"), "source").select(
        "source", "tokens", number).groupBy("source", "block").agg(F.sum("tokens").alias("size")), "mix-blocks")
    epochs = F.ceil(F.col("target") / F.col("tokens"))
    turns = block_sums.join(plan, "source").select(
        "source", "block", "size", "target", "weight", F.col("tokens").alias("whole"),
        F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)).alias("epoch"))
    # blocks in hashed order, by ranges of the hash, so that no task holds all blocks of a source
    place = _unit(F.lit(str(mix.seed)), F.col("epoch").cast("string"), F.col("block").cast("string"))
    turns = turns.withColumn("place", place).withColumn("part", F.substring("place", 1, RANGE))
    up_to = (Window.unboundedPreceding, 0)
    parts = Window.partitionBy("source", "epoch").orderBy("part").rowsBetween(*up_to)
    within = Window.partitionBy("source", "epoch", "part").orderBy("place", "block").rowsBetween(*up_to)
    held = turns.groupBy("source", "epoch", "part").agg(F.sum("size").alias("held")).select(
        "source", "epoch", "part", (F.sum("held").over(parts) - F.col("held")).alias("earlier"))
    turns = turns.join(held, ["source", "epoch", "part"]).withColumn(
        "before", F.col("epoch") * F.col("whole") + F.col("earlier") + F.sum("size").over(within) - F.col("size"))
    visits = turns.where(F.col("before") < F.col("target")).groupBy("source", "block", "weight", "target").agg(
        F.collect_list(F.struct("epoch", "before")).alias("visits"))

    inside = Window.partitionBy("source", "block").orderBy(
        _unit(F.lit(str(mix.seed)), F.lit("row"), "key"), "key", "tie")
    placed = dealt.withColumn("offset", F.sum("tokens").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    joined = placed.join(visits, ["source", "block"]).select(
        "row", "source", "tokens", "block", "weight", "target", "offset", F.explode("visits").alias("visit"))
    start = F.col("visit.before") + F.col("offset")
    return joined.where(start < F.col("target")).select(
        "row", "source", "tokens", "weight", F.col("visit.epoch").alias("epoch"), "block",
        start.alias("start"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document once or more, by the weight of its source."""
    return mix_sources(docs, Mix()).select("row.*")


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The realised mixture of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs, keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "source", "tokens", "weight", "epoch", "block", "start")
