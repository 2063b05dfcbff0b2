"""Fingerprints: rates by length, copies in the lexicon, many ranges of ids, all against the SQL."""

from __future__ import annotations

import random

import duckdb
import pytest

from tests.oracle import compare
from turnout.llm import imatch

SCHEMA = "doc_id long, text string"


def sentence(rng: random.Random, words: int, stock: int) -> str:
    return " ".join(f"w{rng.randrange(stock)}" for _ in range(words))


@pytest.fixture(scope="module")
def mixed():
    """Copies that make a third of the rows, texts of 0 to 6,000 words, nulls, marks beyond ASCII, gaps in the ids."""
    rng = random.Random(11)
    texts = [sentence(rng, rng.choice([5, 40, 200]), 900) for _ in range(60)] + [sentence(rng, 150, 900)] * 40
    texts += [sentence(rng, 6000, 9000), None, "", "  ,;", "Über ÉTÉ 東京 w1 w2", "solo"]
    rng.shuffle(texts)
    return [(i * i * 1000 - 5000, t) for i, t in enumerate(texts)]


def test_against_sql_over_many_ranges(spark, mixed, tmp_path, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET_CHARS", 20_000)
    docs = spark.createDataFrame(mixed, SCHEMA)
    path = f"{tmp_path}/documents.parquet"
    docs.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert compare(imatch.fingerprint_documents(docs), con, imatch._sql()) is None


def test_shuffled_lexicon_gives_the_same(spark, mixed, monkeypatch):
    docs = spark.createDataFrame(mixed, SCHEMA)
    want = sorted(map(tuple, imatch.fingerprint_documents(docs).collect()))
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", 0)
    assert sorted(map(tuple, imatch.fingerprint_documents(docs).collect())) == want


def test_copies_and_long_texts_keep_places(spark, mixed):
    found = {r.doc_id: r for r in imatch.fingerprint_documents(spark.createDataFrame(mixed, SCHEMA)).collect()}
    assert len(found) == len(mixed)
    by_text = {}
    for doc_id, text in mixed:
        by_text.setdefault(text or "", set()).add(found[doc_id].fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    copies = [doc_id for doc_id, text in mixed if [t for _, t in mixed].count(text) == 40]
    assert all(":" in found[i].fingerprint and found[i].near_edited > 0 for i in copies)
    longest = max(mixed, key=lambda row: len(row[1] or ""))[0]
    assert int(found[longest].fingerprint.split(":")[0]) >= 2 and found[longest].near_edited > 0.2


def test_texts_without_terms_are_told_apart_by_their_whole_digest(spark):
    docs = spark.createDataFrame([(1, "..."), (2, "..."), (3, ";;;")], SCHEMA)
    found = {r.doc_id: r for r in imatch.fingerprint_documents(docs).collect()}
    assert len(found[1].fingerprint) == 32 and found[1].near_next == 1.0 and found[2].near_next == 0.0
