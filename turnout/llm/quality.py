"""Quality by a linear-chain conditional random field over lines.

Every line of a labelled document takes the document's label. The field has one
weight per feature of a line and of its neighbours and a 2 x 2 table for
neighbouring labels. Forward-backward marginals of the good label, weighted by
line length, are the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnout.llm.common import stored, table
from turnout.llm.language import held_out
from turnout.llm.registry import query
from turnout.llm.words import text_parts, words_of

#: Most labelled documents used to fit; those with the smallest hashed ids are taken.
FIT_DOCUMENTS = 6_000
#: Documents are taken whole, in that order, until they have so many lines together.
FIT_LINES = 400_000
STEPS = 150
RATE = 0.1
DECAY = 1e-3
LOWER, UPPER, DIGIT, BLANK, STOP, SHOUT, BAR, SYMBOL, OTHER = range(9)
FEATURES = 14


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Kind of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.int64)
    for i in range(0x3000):
        c = chr(i)
        out[i] = (DIGIT if c.isdigit() else UPPER if c.isupper() else LOWER if c.isalpha()
                  else BLANK if c.isspace() else STOP if c in ".,;:'-" else SHOUT if c in "!?"
                  else BAR if c in "|<>{}[]" else SYMBOL if i < 128 else OTHER)
    out[0x3000:0xE000] = LOWER
    return out


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, document index) of every line of every text; an empty text is one line."""
    lines = [text.split("\n") for text in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in lines])
    flat = [line for some in lines for line in some]
    sizes = np.array([len(x) for x in flat], dtype=np.int64)
    points = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    line_no = np.repeat(np.arange(len(flat)), sizes)
    counts = np.bincount(line_no * 9 + kinds()[points], minlength=9 * len(flat)).reshape(-1, 9)
    hashes, at = words_of(flat)
    words = np.bincount(at, minlength=len(flat))
    order = np.lexsort((hashes, at))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (at[order][1:] != at[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    distinct = np.bincount(at[order][fresh], minlength=len(flat))
    seen: set = set()
    repeated = np.zeros(len(flat))
    for i, (doc, line) in enumerate(zip(owner.tolist(), flat)):
        key = (doc, line)
        if key in seen:
            repeated[i] = 1.0
        seen.add(key)
    size = np.maximum(sizes, 1)
    shares = counts[:, [UPPER, DIGIT, BLANK, STOP, SHOUT, BAR, SYMBOL, OTHER]] / size[:, None]
    letters = counts[:, LOWER] + counts[:, UPPER]
    rest = np.column_stack([
        np.log1p(sizes), np.log1p(words), letters / np.maximum(words, 1) / 10,
        distinct / np.maximum(words, 1), repeated, (sizes == 0).astype(float)])
    return np.column_stack([shares, rest]), sizes, owner


def with_neighbours(features: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, zero beyond a document's ends, and a constant."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    same = owner[1:] == owner[:-1]
    before[1:][same] = features[:-1][same]
    after[:-1][same] = features[1:][same]
    return np.column_stack([features, before, after, np.ones(len(features))])


def marginals(unary: np.ndarray, owner: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) per line, expected counts of neighbouring label pairs) for all documents at once.

    Documents advance together, line by line, those that have ended dropping out.
    """
    n = np.bincount(owner) if len(owner) else np.empty(0, dtype=np.int64)
    first = np.cumsum(n) - n
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    score = np.column_stack([np.zeros(len(unary)), unary])
    forward, backward = score.copy(), np.zeros_like(score)
    table = np.exp(steps)

    def through(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
        top = values.max(axis=1, keepdims=True)
        return np.log(np.exp(values - top) @ weights) + top

    alive = [int(np.searchsorted(-n, -t, side="left")) for t in range(int(n[0]) if len(n) else 0)]
    for t in range(1, len(alive)):
        at = first[:int(np.searchsorted(-n, -t, side="left"))] + t
        forward[at] += through(forward[at - 1], table)
    for t in range(len(alive) - 1, 0, -1):
        at = first[:int(np.searchsorted(-n, -t, side="left"))] + t
        backward[at - 1] = through(backward[at] + score[at], table.T)
    both = forward + backward
    top = both.max(axis=1, keepdims=True)
    total = np.log(np.exp(both - top).sum(axis=1)) + top[:, 0]
    good = np.exp(both[:, 1] - total)
    pairs = np.flatnonzero(owner[1:] == owner[:-1])
    joint = np.exp(forward[pairs][:, :, None] + steps[None] + (score + backward)[pairs + 1][:, None, :]
                   - total[pairs][:, None, None])
    return good, joint.sum(axis=0)


def fit(features: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> dict:
    """Weights by gradient steps on the likelihood of the line labels; owner counts 0, 1, ..."""
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = with_neighbours(np.clip((features - mean) / spread, -5, 5), owner)
    y = labels[owner].astype(float)
    w, steps = np.zeros(x.shape[1]), np.zeros((2, 2))
    pairs = np.flatnonzero(owner[1:] == owner[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[pairs].astype(int), y[pairs + 1].astype(int)), 1)
    theta = np.concatenate([w, steps.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        good, expected = marginals(x @ theta[:-4], owner, theta[-4:].reshape(2, 2))
        slope = np.concatenate([x.T @ (y - good), (seen - expected).ravel()]) / len(y) - DECAY * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return {"mean": mean, "spread": spread, "w": theta[:-4], "steps": theta[-4:].reshape(2, 2)}


def score_texts(texts: list[str], model: dict | None) -> np.ndarray:
    """Scores of texts; 0.5 without a model."""
    if model is None:
        return np.full(len(texts), 0.5)
    features, sizes, owner = line_features(texts)
    x = with_neighbours(np.clip((features - model["mean"]) / model["spread"], -5, 5), owner)
    good, _ = marginals(x @ model["w"], owner, model["steps"])
    weight = np.maximum(sizes, 1)
    return np.clip(np.bincount(owner, weights=good * weight) / np.bincount(owner, weights=weight), 0.0, 1.0)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_parts(batch):
            features, _, owner = line_features(texts)
            cut = np.split(features, np.flatnonzero(np.diff(owner)) + 1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(0), "quality": part.column(1).cast(pa.int32()),
                "features": pa.array([x.astype("<f4").tobytes() for x in cut], pa.binary())})


def learn_quality(docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS) -> dict | None:
    """A model from labelled rows outside the held-out fifth; None if there are not both labels.

    Fitted on up to ``documents`` labelled documents, chosen by hash, all of
    their lines. No further document is taken after ``FIT_LINES`` lines, but the
    first of each label. Of repeated labels the smallest counts; rows with a null
    id or label teach nothing.
    """
    chosen = labels.where(~held_out(5, 0) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")).where("quality IN (0, 1)").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(documents)
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "quality", "text"), "quality-sample")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sizes = rows.groupBy("doc_id", "quality", F.xxhash64("doc_id").alias("place")).agg(
        F.sum(F.coalesce(lines, F.lit(1))).alias("lines")).toPandas().sort_values(["place", "doc_id"])
    taken = (sizes["lines"].cumsum() - sizes["lines"] < FIT_LINES) | ~sizes["quality"].duplicated()
    if not taken.all():
        rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame(
            [(int(i),) for i in sizes["doc_id"][taken]], "doc_id long")), "doc_id").select("doc_id", "quality", "text")
    found = rows.mapInArrow(_features, "doc_id long, quality int, features binary").toPandas().sort_values(
        ["doc_id", "features"])
    if found["quality"].nunique() < 2:
        return None
    parts = [np.frombuffer(x, dtype="<f4").reshape(-1, FEATURES) for x in found["features"]]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return fit(np.concatenate(parts).astype(float), owner, found["quality"].to_numpy())


def score_documents(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score for every row, from the text alone.

    Null texts are empty; an empty text is one empty line and gets a score too.
    Rows are independent: repeated ones get equal scores, an empty table gives
    no rows. Only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score_texts(texts, shared.value), pa.float64())],
                    ["doc_id", "score"])

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, "doc_id long, score double")


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = learn_quality(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
