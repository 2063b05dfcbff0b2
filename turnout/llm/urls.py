"""URL filter: rules first, then a path-template tree per host.

Segments are generalised by shape (digits, long hex), counted per host, and the
tree of these shapes is walked down from the root to the ends of all paths:
children merge into one wildcard unless their own children or their labels show
them to differ from their siblings, however many these are. Pages that a rule
decides are the labels of the resulting templates; a template is rejected when
its share of blocked labels, smoothed towards its host's and the whole corpus's,
reaches a threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnout.llm.common import stored, table
from turnout.llm.registry import query

#: (verdict, rule): fixed values of the query's contract.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    """``overlap``: likeness to its siblings from which a branch merges in any case; ``alpha``: chance
    that a branch like its siblings counts as another by its children; ``z``: least deviation, in
    standard errors, of a branch's share of blocked labels that parts it; ``weight``: labels that the
    smoothing prior counts for; ``reject``: least share of blocked labels."""

    overlap: float = 0.6
    alpha: float = 0.05
    z: float = 1.96
    weight: float = 5.0
    reject: float = 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://``; both empty if that is missing or the url null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; ``rules`` is a short list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, text in sorted(rules, key=lambda r: len(r[1])):
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(name)).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """Segments by shape."""
    marked = F.regexp_replace(path, r"(^|/)[0-9a-fA-F]{16,}(?=/|$)", "$1{h}")
    marked = F.regexp_replace(marked, r"[0-9]+", "{n}")
    return F.split(F.regexp_replace(marked, r"^/", ""), "/", -1)


def merging(here: DataFrame, settings: Settings) -> DataFrame:
    """(host, above, child, alone, merge) from rows (host, above, child, follow, n, n_block, n_allow).

    A child is compared to all its siblings together. It differs by what follows
    if the distance of the two distributions is more than chance gives with
    ``alpha`` for any number of values (McDiarmid's bound on the Euclidean
    distance), and they overlap by less than ``overlap``; by labels if the shares
    of blocked ones are ``z`` standard errors apart (with Yates's correction).
    All of it comes from sums over the child's own rows and over the node.
    ``alone`` marks nodes of one row.
    """
    number = lambda c: F.col(c).cast("double")
    by_follow = here.groupBy("host", "above", "child", "follow").agg(
        F.sum("n").alias("n"), F.sum("n_block").alias("b"), F.sum("n_allow").alias("a"),
        F.count(F.lit(1)).alias("rows"))
    pooled = by_follow.groupBy("host", "above", "follow").agg(
        F.sum("n").alias("pool"), F.sum("b").alias("b"), F.sum("a").alias("a"), F.sum("rows").alias("rows"))
    nodes = pooled.groupBy("host", "above").agg(
        F.sum("pool").alias("n_node"), F.sum(number("pool") * number("pool")).alias("pool_pool"),
        F.sum("b").alias("b_node"), F.sum("a").alias("a_node"), F.sum("rows").alias("rows_node"))
    child_sum = by_follow.groupBy("host", "above", "child").agg(F.sum("n").alias("n_child"))
    others = F.greatest(number("n_node") - number("n_child"), F.lit(1.0))
    sums = (by_follow.join(pooled.select("host", "above", "follow", "pool"), ["host", "above", "follow"])
            .join(child_sum, ["host", "above", "child"]).join(nodes, ["host", "above"])
            .groupBy("host", "above", "child", "n_child", "n_node", "pool_pool", "b_node", "a_node", "rows_node").agg(
                F.sum("b").alias("b"), F.sum("a").alias("a"),
                F.sum(number("n") * number("n")).alias("own_own"), F.sum(number("n") * number("pool")).alias("own_pool"),
                F.round(F.sum(F.least(number("n") / F.col("n_child"),
                                      (number("pool") - number("n")) / others)), 9).alias("like")))
    n, rest = number("n_child"), number("n_node") - number("n_child")
    apart = (F.col("own_own") / (n * n) - 2 * (F.col("own_pool") - F.col("own_own")) / (n * rest)
             + (F.col("pool_pool") - 2 * F.col("own_pool") + F.col("own_own")) / (rest * rest))
    bound = (1 + math.sqrt(math.log(1 / settings.alpha))) ** 2 * (1 / n + 1 / rest)
    follows_differ = (F.round(apart, 9) > F.round(bound, 9)) & (F.col("like") < settings.overlap)
    m, others_m = number("b") + number("a"), number("b_node") + number("a_node") - number("b") - number("a")
    share = number("b_node") / (number("b_node") + number("a_node"))
    gap = F.abs(number("b") / m - (number("b_node") - number("b")) / others_m) - (1 / m + 1 / others_m) / 2
    labels_differ = (m > 0) & (others_m > 0) & F.coalesce(F.round(
        gap / F.sqrt(F.nullif(share * (1 - share), F.lit(0.0)) * (1 / m + 1 / others_m)), 9) >= settings.z, F.lit(False))
    return sums.select("host", "above", "child", (F.col("rows_node") == 1).alias("alone"), F.when(
        rest > 0, ~follows_differ & ~labels_differ).otherwise(F.lit(False)).alias("merge"))


def template_tree(shapes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Adds ``template`` to rows (host, segs, n, ...) that are distinct in host and segs.

    A path that is the only one below its node is finished there, so there are as
    many rounds as the longest beginning that two paths share, plus one.
    """
    rows, finished, level = shapes.withColumn("template", F.lit("")), [], 0
    while True:
        child = F.get("segs", F.lit(level))
        follow = F.coalesce(F.get("segs", F.lit(level + 1)), F.lit("<end>"))
        named = rows.withColumnRenamed("template", "above").withColumn("child", child)
        merged = merging(named.select("host", "above", "child", follow.alias("follow"), "n", "n_block", "n_allow"), settings)
        tail = F.array_join(F.slice("segs", F.lit(level + 1), F.size("segs")), "/")
        stepped = stored(named.join(merged, ["host", "above", "child"]).select(
            *shapes.columns, F.concat("above", F.lit("/"), F.when(F.col("alone"), tail).when(
                F.col("merge"), F.lit("*")).otherwise(F.col("child"))).alias("template"),
            (F.col("alone") | (F.size("segs") == level + 1)).alias("finished")), "url-tree")
        finished.append(stepped.where("finished").drop("finished"))
        rows = stepped.where("NOT finished").drop("finished")
        if not rows.limit(1).count():
            return reduce(DataFrame.unionAll, finished)
        level += 1


def judge_templates(tree: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Adds ``share`` (smoothed share of blocked labels) and ``method_verdict``."""
    m = settings.weight
    sums = [F.sum("n_block").alias("b"), F.sum("n_allow").alias("a")]
    whole = tree.agg(*sums).select(((F.coalesce("b", F.lit(0)) + 1) / (
        F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0)) + 2)).alias("p_all"))
    hosts = tree.groupBy("host").agg(*sums).join(F.broadcast(whole)).select("host", (
        (F.col("b") + m * F.col("p_all")) / (F.col("a") + F.col("b") + m)).alias("p_host"))
    leaves = tree.groupBy("host", "template").agg(*sums).join(hosts, "host").select(
        "host", "template", F.round((F.col("b") + m * F.col("p_host")) / (
            F.col("a") + F.col("b") + m), 9).alias("share"))
    return tree.join(leaves, ["host", "template"]).withColumn(
        "method_verdict", F.when(F.col("share") >= settings.reject, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, rules=RULES, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``pages`` (page_id, url; other columns are not read).

    Returns page_id, host, path, rule, verdict, template, share. A null url or
    one without ``://`` has host and path empty and is judged by the method like
    any other. Repeated rows are all kept and judged alike; an empty table gives
    no rows.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, ruled = match_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), ruled.alias("ruled"),
                       shape(F.col("path")).alias("segs"))
    shapes = stored(rows.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ruled") == "block").alias("n_block"),
        F.count_if(F.col("ruled") == "allow").alias("n_allow")), "url-shapes")
    judged = stored(judge_templates(template_tree(shapes, settings), settings).select(
        "host", "segs", "template", "share", "method_verdict"), "url-verdicts")
    return rows.join(judged, ["host", "segs"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", "method_verdict").alias("verdict"), "template", "share")


@query("op10_urls")
def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rule or template."""
    return filter_urls(table(spark, sf_dir, "pages"))
