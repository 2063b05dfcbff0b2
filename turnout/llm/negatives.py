"""Hard negatives by Four-Russians scoring of integer vectors.

An anchor's components are cut into groups of eight; for each group a table
holds the sums of all 256 subsets. A candidate's components are packed as bit
planes: one byte for each group and bit, naming the components that have the
bit. A full inner product is then a lookup for each byte, shifted and added
plane by plane (the highest plane of a two's complement number is negative).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from turnout.llm.common import stored, table
from turnout.llm.registry import query

GROUP = 8
#: Candidates and anchors of a group, and those that are scored at a time.
CANDIDATES = 16384
ANCHORS = 8192
CHUNK, TABLES = 4096, 64
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of its positive's.
LOW, HIGH = 30, 90
LEAST, MOST = -2**63, 2**63 - 1
#: Whole numbers of smaller size keep sums and shifts within 64 bits.
SAFE = 1 << 62


def whole(vectors: list) -> np.ndarray:
    """floor(256 x) per component of equally long vectors; Python integers where 64 bits could overflow."""
    raw = np.floor(256.0 * np.array(vectors, dtype=np.float64).reshape(len(vectors), -1))
    if raw.size and np.abs(raw).max() >= 2.0 ** 52:
        return np.array([[int(x) for x in row] for row in raw], dtype=object)
    return raw.astype(np.int64)


def planes_of(points: np.ndarray) -> np.ndarray:
    """Bit planes (rows, planes, groups of eight as bytes) of two's complement components, lowest plane first."""
    rows, size = points.shape
    groups = -(-size // GROUP)
    most = max((abs(int(x)) for x in (points.max(), points.min())), default=0) if points.size else 0
    planes = most.bit_length() + 1
    out = np.empty((rows, planes, groups), np.uint8)
    for b in range(planes):
        out[:, b] = np.packbits(((points >> b) & 1).astype(bool), axis=1, bitorder="little") if size else 0
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Table (group, 256 subsets, anchor) of sums of eight components each."""
    count, size = anchors.shape
    groups = -(-size // GROUP)
    padded = np.zeros((count, groups * GROUP), anchors.dtype)
    padded[:, :size] = anchors
    parts = padded.reshape(count, groups, GROUP)
    sums = np.zeros((groups, 256, count), anchors.dtype)
    for j in range(GROUP):
        sums[:, 1 << j:2 << j] = sums[:, :1 << j] + parts[:, :, j].T[:, None, :]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products (rows, anchors): every byte looked up, planes shifted and added from the highest on."""
    total = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    for b in reversed(range(planes.shape[1])):
        level = np.zeros_like(total)
        for g in range(planes.shape[2]):
            level += sums[g][planes[:, b, g]]
        total = total * 2 + (-level if b == planes.shape[1] - 1 else level)
    return total


def _table_type(anchors: np.ndarray, planes: int) -> np.ndarray:
    """Anchors in the narrowest type that holds every score exactly."""
    most = max((sum(abs(int(x)) for x in row) for row in anchors), default=0) << planes
    return anchors.astype(np.int32 if most < 2**30 else np.int64 if most < SAFE else object)


def _spread_planes(packed: pd.Series, planes: np.ndarray) -> np.ndarray:
    """Planes of rows packed with different numbers of planes; missing high ones repeat the sign."""
    groups = len(packed.iloc[0]) // int(planes[0])
    out = np.empty((len(packed), int(planes.max()), groups), np.uint8)
    for some in np.unique(planes):
        at = np.flatnonzero(planes == some)
        got = np.frombuffer(b"".join(packed.iloc[at]), np.uint8).reshape(len(at), some, groups)
        out[at, :some] = got
        out[at, some:] = got[:, -1:]
    return out


def _scored(points: pd.DataFrame, anchors: pd.DataFrame) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first point, first anchor, scores) over chunks of both; ``points`` packed, ``anchors`` as vectors."""
    planes = _spread_planes(points["packed"], points["planes"].to_numpy())
    for a in range(0, len(anchors), TABLES):
        sums = subset_sums(_table_type(whole(anchors["embedding"].iloc[a:a + TABLES].tolist()), planes.shape[1]))
        for p in range(0, len(points), CHUNK):
            yield p, a, scores(planes[p:p + CHUNK], sums)


def checked(score: int) -> int:
    """A score as it is, if 64 bits hold it."""
    if not LEAST <= score <= MOST:
        raise OverflowError(f"a score of {score} is beyond 64 bits")
    return int(score)


def _best(values: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest values, best first, ties by smaller id."""
    if len(values) > 4 * k:
        limit = np.partition(values, len(values) - k)[len(values) - k]
        some = np.flatnonzero(values >= limit)
    else:
        some = np.arange(len(values))
    return some[np.lexsort((ids[some], -values[some]))[:k]]


def _positives(count: int):
    def run(points: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(anchors):
            points, anchors = points.reset_index(drop=True), anchors.reset_index(drop=True)
            ids = points["vec_id"].to_numpy()
            for p, a, found in _scored(points, anchors):
                for j in range(found.shape[1]):
                    row = anchors.iloc[a + j]
                    chunk_ids = ids[p:p + len(found)]
                    other = np.flatnonzero(chunk_ids != row["vec_id"])
                    for at in other[_best(found[other, j], chunk_ids[other], count)]:
                        out.append((row["vec_id"], row["copy"], chunk_ids[at], checked(found[at, j])))
        return pd.DataFrame(out, columns=["anchor_id", "copy", "positive_id", "positive_score"], dtype="int64")
    return run


def _negatives(count: int, low: int, high: int):
    def run(points: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(anchors):
            points, anchors = points.reset_index(drop=True), anchors.reset_index(drop=True)
            ids, labels = points["vec_id"].to_numpy(), points["label"].to_numpy()
            for p, a, found in _scored(points, anchors):
                chunk_ids, chunk_labels = ids[p:p + len(found)], labels[p:p + len(found)]
                for j in range(found.shape[1]):
                    row = anchors.iloc[a + j]
                    other = np.flatnonzero((chunk_labels != row["label"]) & (chunk_ids != row["vec_id"]))
                    values = found[other, j]
                    for place, score in enumerate(row["scores"]):
                        score = int(score)
                        inside = np.flatnonzero((values >= -((-low * score) // 100)) & (values <= (high * score) // 100))
                        for at in inside[_best(values[inside], chunk_ids[other[inside]], count)]:
                            out.append((row["vec_id"], row["copy"], place, chunk_ids[other[at]], checked(values[at])))
        return pd.DataFrame(out, columns=["anchor_id", "copy", "place", "negative_id", "negative_score"], dtype="int64")
    return run


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives for the best positives of every anchor.

    ``vectors`` and ``anchors`` (rows of ``vectors``) have ``vec_id``, ``label``
    and ``embedding``; other columns are not read. Rows with a null id, a null
    label, a null vector or a null or non-finite component take no part; vectors
    only meet vectors of their own length. Scores are inner products of
    floor(256 x); higher ones come first, ties go to the smaller id. An anchor's
    positives are its best rows of the same label and another id. Its negatives
    for one positive are the best rows of other labels and another id whose
    score is between ``low`` and ``high`` percent of the positive's. Rows that
    repeat an id are rows (and anchors) of their own. A score beyond 64 bits is
    an error. Returns anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score; an empty table gives no rows.

    Every row meets every anchor once: with its own label in the search for
    positives, with other labels after it. A group is a block of ``CANDIDATES``
    rows with a block of ``ANCHORS`` anchors, whatever the labels' sizes.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").where(
            "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, "
            "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('infinity'))").withColumn(
            "size", F.size("embedding"))

    names = ["vec_id", "label", "size", "planes", "packed"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy()
            for length in np.unique(size):
                some = batch.take(pa.array(np.flatnonzero(size == length)))
                planes = planes_of(whole(some.column(3).to_pylist()))
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(
                    np.full(len(planes), planes.shape[1], np.int32)), pa.array([x.tobytes() for x in planes], pa.binary())], names)

    rows = stored(clean(vectors).select("vec_id", "label", "size", "embedding").mapInArrow(
        pack, "vec_id long, label long, size int, planes int, packed binary"), "planes")
    # repeated ids: anchors of their own, told apart by their place among the rows with the id
    twin = Window.partitionBy("vec_id").orderBy("embedding", "label")
    asked = stored(clean(anchors).withColumn("copy", F.row_number().over(twin).cast("long")), "anchors")

    spread = F.xxhash64("vec_id", F.lit(1))

    def blocks(n: str, held: int) -> Column:
        return F.greatest(F.ceil(F.coalesce(F.col(n), F.lit(0)) / held).cast("long"), F.lit(1).cast("long"))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    # positives: rows and anchors of one label and length, in blocks
    keys = ["label", "size"]
    sizes = stored(asked.groupBy(*keys).agg(F.count("vec_id").alias("m")).join(
        rows.groupBy(*keys).agg(F.count("vec_id").alias("n")), keys).select(
        *keys, blocks("n", CANDIDATES).alias("row_blocks"), blocks("m", ANCHORS).alias("anchor_blocks")), "label-sizes")
    groups = [*keys, "low", "high"]
    left = rows.join(sizes, keys).select(
        *rows.columns, F.pmod(spread, "row_blocks").alias("low"), every("anchor_blocks").alias("high"))
    right = asked.join(sizes, keys).select(
        *asked.columns, F.pmod(spread, "anchor_blocks").alias("high"), every("row_blocks").alias("low"))
    found = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(
        _positives(positives), "anchor_id long, copy long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id", "copy").orderBy(F.desc("positive_score"), "positive_id")
    chosen = stored(found.withColumn("place", (F.row_number().over(best) - 1).cast("long")).where(
        F.col("place") < positives), "positives")

    # negatives: all rows, in blocks of one length
    with_scores = chosen.groupBy("anchor_id", "copy").agg(F.array_sort(F.collect_list(
        F.struct("place", "positive_score"))).alias("of")).select(
        F.col("anchor_id").alias("vec_id"), "copy", F.col("of.positive_score").alias("scores"))
    ready = stored(asked.join(with_scores, ["vec_id", "copy"]), "scored-anchors")
    sizes = stored(ready.groupBy("size").agg(F.count("vec_id").alias("m")).join(
        rows.groupBy("size").agg(F.count("vec_id").alias("n")), "size").select(
        "size", blocks("n", CANDIDATES).alias("row_blocks"), blocks("m", ANCHORS).alias("anchor_blocks")), "sizes")
    groups = ["size", "low", "high"]
    left = rows.join(sizes, "size").select(
        *rows.columns, F.pmod(spread, "row_blocks").alias("low"), every("anchor_blocks").alias("high"))
    right = ready.join(sizes, "size").select(
        *ready.columns, F.pmod(spread, "anchor_blocks").alias("high"), every("row_blocks").alias("low"))
    found = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(
        _negatives(negatives, low, high), "anchor_id long, copy long, place long, negative_id long, negative_score long")
    best = Window.partitionBy("anchor_id", "copy", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.join(chosen, ["anchor_id", "copy", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def moved_labels(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose vec_id is divisible by ``every`` with the next label, modulo ``labels``."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return vectors.select("vec_id", moved.alias("label"), "embedding")


_SQL = """
WITH ok AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER () AS row_id
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row_id AS anchor, a.vec_id AS anchor_id, c.row_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ok a JOIN ok c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, anchor_id, row_id, vec_id, score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row_id) AS place
  FROM scored WHERE same QUALIFY place <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
         n.score AS negative_score, CAST(row_number() OVER (
           PARTITION BY p.anchor, p.row_id ORDER BY n.score DESC, n.vec_id, n.row_id) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
    AND 30 * CAST(p.score AS HUGEINT) <= 100 * CAST(n.score AS HUGEINT)
    AND 100 * CAST(n.score AS HUGEINT) <= 90 * CAST(p.score AS HUGEINT))
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query("op12_negatives", _SQL)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every vector whose id is divisible by 100."""
    vectors = moved_labels(table(spark, sf_dir, "embeddings"))
    return hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))
