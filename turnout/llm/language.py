"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams in order. A text's own
most frequent n-grams are compared to each profile by how far out of place they
are; an n-gram that a profile lacks counts as far as possible.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from turnout.llm.common import stored, table
from turnout.llm.registry import query
from turnout.llm.words import text_parts

PROFILE = 400
MOST_LANGUAGES = 2_000
SPACE = 32
PENDING = 2_000_000
#: The pipeline rejects texts that score less than LIMIT_SHARE of what all but LIMIT_TAIL of the training
#: documents of their language and size score. With few documents the limit is drawn to that of the language,
#: of all documents and at last LEAST_SCORE, each counting as LIMIT_PRIOR documents.
LIMIT_TAIL = 0.001
LIMIT_SHARE = 0.8
LIMIT_PRIOR = 50
LEAST_SCORE = 0.05


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """Code point to lower-case letter, a space for whatever is no letter."""
    out = np.full(0x110000, SPACE, dtype=np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


def grams_of(text: str) -> np.ndarray:
    """Packed 1- to 3-grams of the letters; words are padded by one space on each side."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = folded()[points]
    padded = np.concatenate([[SPACE], letters, [SPACE]])
    solid = padded != SPACE
    solid[1:] |= padded[:-1] != SPACE
    solid[0] = True
    run = padded[solid]
    if len(run) < 3:
        return np.empty(0, dtype=np.int64)
    two = run[:-1] << 21 | run[1:]
    three = (two[:-1] << 21 | run[2:])[run[1:-1] != SPACE]
    return np.concatenate([run[run != SPACE], two, three])


def counted(grams: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order with their counts."""
    if weights is not None:
        distinct, place = np.unique(grams, return_inverse=True)
        return distinct, np.bincount(place, weights=weights, minlength=len(distinct)).astype(np.int64)
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.empty(0, int)
    return grams[first], np.diff(np.append(first, len(grams)))


def ranked(text: str, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by code."""
    grams, counts = counted(grams_of(text))
    if not len(grams):
        return grams
    key = (counts.max() - counts) * np.int64(len(grams)) + np.arange(len(grams))
    if len(key) > size:
        key = np.partition(key, size)[:size]
    return grams[np.sort(key) % len(grams)]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = defaultdict(list)
    waiting = 0

    def flush(final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal waiting
        waiting = 0
        for lang in list(held):
            grams, counts = (np.concatenate(x) for x in zip(*held[lang]))
            grams, counts = counted(grams, counts)
            held[lang] = [(grams, counts)]
            waiting += len(grams)
        if final or waiting > PENDING // 2:
            for lang, [(grams, counts)] in held.items():
                for at in range(0, len(grams), 10_000):
                    part = slice(at, at + 10_000)
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [lang] * len(grams[part]), "gram": grams[part], "n": counts[part]})
            held.clear()
            waiting = 0

    for batch in batches:
        for part, texts in text_parts(batch):
            for lang, text in zip(part.column(0).to_pylist(), texts):
                grams, counts = counted(grams_of(text))
                held[lang].append((grams, counts))
                waiting += len(grams)
                if waiting > PENDING:
                    yield from flush(False)
    if held:
        yield from flush(True)


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, gram, place) from rows with text and lang; every n-gram of every text is counted.

    Rows with a null text or lang teach nothing.
    """
    counts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text").mapInArrow(
        _count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)


def predict(docs: DataFrame, profiles: DataFrame, size: int = PROFILE,
            names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """Language and score added to the columns of ``docs`` under ``names``, from ``text`` alone.

    A third name adds how many distinct n-grams the text was judged by.

    A null text, one without letters, or an empty set of profiles gives ``und``
    and 0. Ties go to the first language by name. Score is 1 less the distance
    to the nearest profile as a part of the largest possible. Rows are
    independent: repeated ones get equal results, an empty table gives no rows.
    Columns that already have one of ``names`` are replaced.
    """
    rows = profiles.select("lang", "gram", "place").limit(MOST_LANGUAGES * size + 1).toPandas()
    if len(rows) > MOST_LANGUAGES * size:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(rows["lang"].unique())
    known = []
    for name in languages:
        own = rows[rows["lang"] == name].sort_values("gram")
        known.append((own["gram"].to_numpy(np.int64), own["place"].to_numpy(np.int64) - 1))
    shared = docs.sparkSession.sparkContext.broadcast((languages, known))

    def judge(text: str) -> tuple[str, float, int]:
        languages, tables = shared.value
        own = ranked(text, size)
        if not len(own) or not languages:
            return "und", 0.0, len(own)
        places = np.arange(len(own))
        best, nearest = None, None
        for name, (grams, order) in zip(languages, tables):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            far = int(np.where(grams[at] == own, np.abs(order[at] - places), size).sum())
            if nearest is None or far < nearest:
                best, nearest = name, far
        return best, max(0.0, 1.0 - nearest / (size * len(own))), len(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch, "text"):
                found = [judge(t) for t in texts]
                added = [pa.array([x[i] for x in found], kind) for i, kind in
                         enumerate((pa.string(), pa.float64(), pa.int64())[:len(names)])]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names_out)

    kept = docs.drop(*names)
    names_out = [*kept.columns, *names]
    schema = T.StructType([*kept.schema.fields, *(
        T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.LongType())))])
    return kept.mapInArrow(run, schema)


def held_out(buckets: int, bucket: int):
    """Whether crc32 of doc_id as text falls into ``bucket``; a null id does not."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets
    return F.coalesce(remainder == bucket, F.lit(False))


def learned_profiles(docs: DataFrame) -> DataFrame:
    """Profiles from all rows but the held-out quarter."""
    return stored(learn_profiles(docs.where(~held_out(4, 2)).select("lang", "text")), "language-profiles")


def size_band(grams: Column) -> Column:
    """Texts of about equal size: the power of two below their number of distinct n-grams."""
    return F.floor(F.log2(F.greatest(grams, F.lit(1)).cast("double"))).cast("int")


def least_scores(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """(lang, band, least): least score of a text of that language and size.

    From the scores of all rows that the profiles were learned from and whose
    language is found right; every learned language has every band up to the
    profile's size.
    """
    rows = predict(docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text"), profiles,
                   names=("lang_pred", "score", "grams")).where("lang_pred = lang")
    counts = stored(rows.groupBy("lang", size_band(F.col("grams")).alias("band"),
                                 F.round("score", 3).alias("score")).agg(F.count(F.lit(1)).alias("n")), "language-scores")
    low = [F.percentile("score", LIMIT_TAIL, F.col("n")).alias("low"), F.sum("n").alias("n")]

    def drawn(wider: Column | float) -> Column:
        n = F.coalesce("n", F.lit(0))
        return (n * F.coalesce("low", F.lit(0.0)) * LIMIT_SHARE + LIMIT_PRIOR * wider) / (n + LIMIT_PRIOR)

    whole = counts.agg(*low).select(drawn(F.lit(LEAST_SCORE)).alias("wider"))
    names = profiles.select("lang").distinct()
    langs = names.join(counts.groupBy("lang").agg(*low), "lang", "left").join(F.broadcast(whole)).select(
        "lang", drawn(F.col("wider")).alias("wider"))
    bands = langs.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(PROFILE.bit_length() - 1))))
    return bands.join(counts.groupBy("lang", "band").agg(*low), ["lang", "band"], "left").select(
        "lang", "band", drawn(F.col("wider")).alias("least"))


def spoken_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without letters, or unlike every language, go."""
    taken = {c.lower() for c in docs.columns}
    lang, score, grams, band, least = (next(f"{n}{i}" for i in range(len(taken) + 1) if f"{n}{i}" not in taken)
                                       for n in ("lang_pred", "score", "grams", "band", "least"))
    profiles = learned_profiles(docs)
    limits = stored(least_scores(docs.where(~held_out(4, 2)), profiles), "language-limits").select(
        F.col("lang").alias(lang), F.col("band").alias(band), F.col("least").alias(least))
    known = predict(docs, profiles, names=(lang, score, grams)).where(F.col(lang) != "und")
    return known.withColumn(band, size_band(F.col(grams))).join(F.broadcast(limits), [lang, band]).where(
        F.col(score) >= F.col(least)).select(*docs.columns)


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from three quarters."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), learned_profiles(docs))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
