"""Fixes and operators 11 to 13 on small frames against plain Python."""

import math
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.llm.test_rows import docs_of, sentence
from tests.oracle import compare, connect
from turnout.llm import kdtree, neardup, negatives, phrases, secrets, simhash, warc
from turnout.session import scratch_path

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


# -- secrets ---------------------------------------------------------------

def test_a_long_run_takes_seconds(spark):
    rng = random.Random(31)
    run = "".join(rng.choice(LETTERS) for _ in range(200_000))
    docs = docs_of(spark, [f"x {run} y", "warm up " + run[:50]])
    secrets.secret_report(docs.where("doc_id = 1")).collect()
    start = time.time()
    found = secrets.secret_report(docs.where("doc_id = 0")).first()
    assert time.time() - start < 60 and "entropy:2:200002" in found.spans


@pytest.mark.parametrize("piece", ["x", "xxxx", "EXAMPLE_", "0123456789", "/", "a", "Q7", "f", "token=abcdefghijklm"])
def test_long_repeats_in_query_and_redaction(spark, piece):
    docs = docs_of(spark, [piece * (200_000 // len(piece))])
    assert secrets.secret_report(docs).first().spans is not None
    assert secrets.redact(docs).first().text is not None


def test_query_finds_what_redaction_finds(spark):
    key = "q7Zr2WkX9bTn4LvJ6mYc8HsD1fPg"
    texts = [f"example/{key}", f"2024-01-01-{key}", "qWzRkXbTnLvJmYcHsDfPgQaU", "A9F3C07BE1D82F64B5A0",
             "abcdefgh/EXAMPLE/xxxx_XXXX", "2024-01-01/2024-01-02", "EXAMPLE_EXAMPLE_EXAMPLE"]
    found = [r.spans for r in secrets.secret_report(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert all("entropy:" in s for s in found[:4]) and not any(found[4:])


def test_windows_brute_force(spark):
    rng = random.Random(32)
    texts = []
    for _ in range(150):
        alphabet = rng.choice(["0123456789abcdefABCDEF", LETTERS, LETTERS[:52], "aab1", "Ab0-_="])
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(18, 60))))
    found = [r.extra for r in secrets.find_secrets(docs_of(spark, texts)).orderBy("doc_id").collect()]
    for text, spans in zip(texts, found):
        want = []
        for m in re.finditer(secrets.RUN, text):
            run = m[0]
            kind = next((c for c in secrets.CLASSES if re.search(c.pattern, run)), None)
            if kind is None or re.search(secrets.ALLOW, run) or re.fullmatch(f"(?:{secrets.PIECES})+", run):
                continue
            size = min(len(run), kind.window) if kind.shrinks else kind.window
            bits = kind.bits * math.log2(size) / math.log2(kind.window)
            high = []
            for o in range(len(run) - size + 1):
                counts = [run[o:o + size].count(c) for c in set(run[o:o + size])]
                if -sum(c / size * math.log2(c / size) for c in counts) >= bits:
                    high.append(o)
            if high:
                want.append((m.start() + high[0], m.start() + high[-1] + size))
        assert [(s.start, s.end) for s in spans] == want, text


# -- archive, search, one document of a class ------------------------------

def test_a_damaged_record_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "a" * 50), (2, "v", "b")], "page_id long, url string, html string")
    for change in (("payloads", "payload", F.lit(b"other")),
                   ("headers", "header", F.replace("header", F.lit("Content-Length: "), F.lit("Content-Length: 1"))),
                   ("headers", "header", F.replace("header", F.lit("sha1:"), F.lit("sha1:0")))):
        archive = warc.write_archive(pages, scratch_path(spark, "warc"))
        whole = warc.read_records(archive, spark).select("payload", "record")
        assert whole.count() == 2 and len(whole.collect()) == 2
        part, column, value = change
        rows = getattr(archive, part)(spark).withColumn(column, value)
        bad = warc.Archive(scratch_path(spark, "warc"))
        for name in ("payloads", "headers"):
            (rows if name == part else getattr(archive, name)(spark)).write.parquet(f"{bad.root}/{name}")
        with pytest.raises(PySparkException, match="damaged"):
            warc.read_records(bad, spark).select("payload").collect()


def test_kdtree_keeps_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [5.0, 5.0]), (1, [5.0, 5.0]), (2, [2.0, 0.0]), (0, [-1.0, -3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = kdtree.top_k(df, df.where("vec_id = 0"), k=4)
    whole = [(i, 256 * np.array(v)) for i, v in rows]
    want = sorted(((int(a @ b), i) for q, a in whole if q == 0 for i, b in whole if i != 0), key=lambda x: (-x[0], x[1]))
    assert [(r.score, r.vec_id) for r in found.orderBy("rank").collect()] == want[:4]
    huge = spark.createDataFrame([(0, [1e10]), (1, [1e10])], "vec_id long, embedding array<double>")
    with pytest.raises(PySparkException, match="beyond 64 bits"):
        kdtree.top_k(huge, huge).collect()


def test_single_documents_keep_texts_and_clashing_columns(spark):
    rng = random.Random(33)
    texts = [sentence(rng, 30) for _ in range(3)]
    rows = [(1, texts[0], "a"), (1, texts[1], "b"), (1, texts[0], "c"), (2, texts[2], "d"), (3, texts[2], "e"), (None, texts[2], "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id string")
    for _ in range(2):
        found = neardup.single_documents(spark, docs, "")
        assert found.columns == docs.columns
        got = found.collect()
        assert sorted((r.doc_id or 0, r.text) for r in got) == sorted(
            [(1, texts[0]), (1, texts[1]), (2, texts[2]), (0, texts[2])])


# -- SimHash ---------------------------------------------------------------

def simhash_of(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(values):
    """Smallest place that each place hangs together with, by pairs within the limit."""
    values = np.array(values, np.uint64)
    label = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None]) <= simhash.LIMIT
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


def test_simhash_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "WINDOW", 50)
    rng = random.Random(34)
    texts = []
    for _ in range(25):
        words = sentence(rng, rng.choice([3, 60, 400])).split()
        for _ in range(4):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "Zz"
            texts.append("\t\r".join(copy) + rng.choice(["", " ", "\x0b"]))
    texts += [None, "", " \n", "One", "one", "two words", "é\xa0ü x y", "\x1c a b", texts[0], texts[0], "a " * 5000]
    docs = docs_of(spark, texts).withColumns({"fingerprint": F.lit(1), "component_id": F.lit("x"), "node": F.lit(2)})
    docs = docs.union(docs.where("doc_id = 3"))
    found = simhash.simhash_components(docs).collect()
    assert len(found) == len(texts) + 1
    want = [simhash_of(t) for t in texts]
    label = grouped(want)
    assert len(set(label)) < len(set(want))
    for r in found:
        assert (r.fingerprint, r.component_id) == (f"{want[r.doc_id]:016x}", label[r.doc_id]), texts[r.doc_id]
    assert simhash.simhash_components(docs.limit(0)).count() == 0
    none = docs.withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    least = {r.component_id for r in simhash.simhash_components(none).where("doc_id IS NULL").collect()}
    assert least == {min((i for i in range(1, len(texts)) if label[i] == 0), default=None)}


@pytest.mark.parametrize("shard, queries", [(40, 1 << 20), (40, 16), (5000, 100)])
def test_shards_lose_no_link(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "QUERIES", queries)
    monkeypatch.setattr(simhash, "LEAF", 8)
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = np.random.default_rng(35)
    values = [int(x) for x in rng.integers(0, 2**63, 300)]
    for x in values[:200]:
        for _ in range(2):
            for bit in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(bit)
            values.append(x)
    values += [77 ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    links = simhash.near_fingerprints(prints).collect()
    place = {x: i for i, x in enumerate(signed)}
    left, right = simhash.forest(len(values), np.array([place[r.left] for r in links]), np.array([place[r.right] for r in links]))
    label = np.arange(len(values))
    label[right] = left
    assert (label == grouped(values)).all() and len(left)


def test_bit_counts_of_long_segments():
    rng = np.random.default_rng(36)
    hashes = rng.integers(0, 2**63, 70_000).astype(np.uint64)
    found = simhash.bit_counts(hashes, np.array([0, 1, 40_000]))
    for row, (a, b) in zip(found, [(0, 1), (1, 40_000), (40_000, 70_000)]):
        assert row.tolist() == [int((hashes[a:b] >> np.uint64(k) & np.uint64(1)).sum()) for k in range(64)]


# -- hard negatives --------------------------------------------------------

def negatives_of(rows, is_anchor):
    good = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if i is not None and lab is not None
            and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, lab, v in good:
        if not is_anchor(a):
            continue
        scored = sorted(((sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in good
                         if i != a and len(w) == len(v)), key=lambda x: (-x[0], x[1]))
        for score, p, _ in [s for s in scored if s[2] == lab][:5]:
            inside = [s for s in scored if s[2] != lab and 30 * score <= 100 * s[0] <= 90 * score]
            out += [(a, p, r + 1, i, score, s) for r, (s, i, _) in enumerate(inside[:10])]
    return sorted(out)


@pytest.mark.parametrize("scale, blocks", [(1.0, (16384, 8192)), (1.0, (7, 3)), (3e5, (50, 5)), (8e5, (16384, 8192))])
def test_negatives_brute_force(spark, monkeypatch, scale, blocks):
    monkeypatch.setattr(negatives, "CANDIDATES", blocks[0])
    monkeypatch.setattr(negatives, "ANCHORS", blocks[1])
    rng = np.random.default_rng(37)
    rows = [(i, int(i % 3), [float(x) for x in (scale * rng.normal(size=11)).round(2) + scale]) for i in range(150)]
    rows += [(200 + i, 1, rows[3][2]) for i in range(20)] + [(0, 1, rows[5][2]), (7, 1, rows[7][2])]
    rows += [(300, None, rows[0][2]), (301, 1, None), (302, 1, [1.0, None]), (303, 2, [math.inf] * 11), (None, 1, rows[1][2]),
             (304, 1, [math.nan] * 11), (400, 9, rows[9][2]), (500, 1, [1.0, 2.0]), (501, 2, [0.5, 1.0]), (502, 1, [1.0, 2.0]),
             (600, 1, []), (601, 1, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {"size": F.lit("x"), "low": F.lit(1), "copy": F.lit(2), "rank": F.lit(3)})
    found = negatives.hard_negatives(df, df.where("vec_id % 100 = 0"))
    want = negatives_of(rows, lambda i: i % 100 == 0)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 50
    assert negatives.hard_negatives(df.limit(0), df.limit(0)).count() == 0


def test_scores_are_inner_products():
    rng = np.random.default_rng(38)
    for size, most in ((1, 5), (8, 2**20), (13, 2**40), (3, 2**70), (0, 1)):
        points, anchors = ([[rng.integers(-2**62, 2**62).item() * most // 2**62 for _ in range(size)] for _ in range(5)] for _ in range(2))
        as_array = lambda v: np.array(v, dtype=object if most > 2**60 else np.int64).reshape(5, size)
        planes = negatives.planes_of(as_array(points))
        sums = negatives.subset_sums(negatives._table_type(as_array(anchors), planes.shape[1]))
        assert negatives.scores(planes, sums).tolist() == [[sum(x * y for x, y in zip(p, a)) for a in anchors] for p in points]


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, 1, [1e10]), (1, 1, [1e10]), (2, 2, [5e9])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(PySparkException, match="beyond 64 bits"):
        negatives.hard_negatives(df, df.where("vec_id = 0")).collect()


# -- collocations ----------------------------------------------------------

def collocations_of(rows, least, percent, most):
    counts, totals = {}, {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    key = lang, tuple(words[i:i + n])
                    counts[key] = counts.get(key, 0) + 1
    out = {}
    for (lang, p), a in counts.items():
        if len(p) < 2 or a < least:
            continue
        if len(p) == 2 and any(len(q) == 3 and o == lang and p in (q[:2], q[1:]) and b >= least and 100 * b >= percent * a
                               for (o, q), b in counts.items()):
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return {(lang, r + 1, p.decode(), -a, x, y, totals[lang], -s)
            for lang, some in out.items() for r, (s, a, p, x, y) in enumerate(sorted(some)[:most])}


@pytest.mark.parametrize("trigger, window, tokens", [(16, 1 << 20, 1 << 19), (1, 64, 20), (2, 1 << 20, 50), (3, 30, 1 << 19)])
def test_collocations_brute_force(spark, monkeypatch, trigger, window, tokens):
    monkeypatch.setattr(phrases, "TRIGGER", trigger)
    monkeypatch.setattr(phrases, "WINDOW", window)
    monkeypatch.setattr(phrases, "TOKENS", tokens)
    rng = random.Random(39)
    vocabulary = ["the", "The", "a", "b", "new", "york", "city", "é", "x" * 300, "ÄB", "q\xa0r"]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; ", "\x0b", "!?"]

    def text():
        return "".join(rng.choice(["new york city ", rng.choice(vocabulary) + rng.choice(gaps)]) for _ in range(rng.randint(0, 60)))

    rows = [(text(), rng.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += rows[:10] + [(None, "en"), ("", None), (" \t ", "fr"), ("a a a a a a a a a a a a a a a", "fr")]
    rows += [(" ".join(rng.choice(vocabulary) for _ in range(900)), "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumns(
        {"phrase": F.lit(1), "a": F.lit(2), "times": F.lit(3), "doc_id": F.lit(4)})
    for least, percent, most in ((10, 50, 2000), (3, 90, 7)):
        found = phrases.collocations(docs, least, percent, most)
        want = collocations_of(rows, least, percent, most)
        assert {tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()} == want and want
    assert phrases.collocations(docs.limit(0)).count() == 0


@pytest.mark.parametrize("trigger, window", [(16, 1 << 20), (1, 64), (2, 1 << 20), (3, 30), (5, 5)])
def test_chunks_hold_every_phrase_once(monkeypatch, trigger, window):
    monkeypatch.setattr(phrases, "TRIGGER", trigger)
    monkeypatch.setattr(phrases, "WINDOW", window)
    rng = random.Random(40)
    gaps = [" ", " ", " ", " ", "  ", "\n", "\n \n"]
    for n in (0, 1, 3, 40, 3000):
        text = "".join(rng.choice(["a", "b", "cc", "dd", "e" * 40]) + rng.choice(gaps[:rng.choice([4, 5, 7])]) for _ in range(n))
        want, found = {}, {}
        for piece in text.split("\n"):
            words = piece.encode().split()
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    want[tuple(words[i:i + k])] = want.get(tuple(words[i:i + k]), 0) + 1
        for chunks, closes in phrases.chunks_of(text.encode()):
            for words in (c.split(b" ") for c in chunks):
                for k in (1, 2, 3):
                    for i in range(len(words) - k + 1):
                        if closes or i < len(words) - 2:
                            found[tuple(words[i:i + k])] = found.get(tuple(words[i:i + k]), 0) + 1
        assert found == want


def test_shingles_of_any_window(monkeypatch):
    rng = random.Random(41)
    texts = ["".join(rng.choice(["ab", "C", "é"]) + rng.choice([" ", "\t\n", "\x0b "]) for _ in range(n)) for n in (0, 1, 2, 3, 50, 400)]
    for window in (1, 7, 1 << 20):
        monkeypatch.setattr(simhash, "WINDOW", window)
        assert simhash.fingerprints([t.encode() for t in texts]).tolist() == [simhash_of(t) for t in texts]


def test_large_scores_stay_exact(spark):
    sql = "SELECT CAST((CAST(1000000 AS HUGEINT) * 999999999999 * 999999999999) // (CAST(999999999999 AS HUGEINT) * 1000000000000) AS BIGINT) AS s"
    a, r = (F.lit(x).cast("decimal(15,0)") for x in (999_999_999_999, 1_000_000_000_000))
    df = spark.range(1).select(F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), a * r).alias("s"))
    assert compare(df, connect("/nowhere"), sql) is None
