"""Operators on small frames against plain Python, with nulls, empty and repeated rows, clashing columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnout.llm import bpe, imatch, kdtree, language, mixing, neardup, quality, secrets, urls, warc
from turnout.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, **columns):
    rows = [(i, t, columns.get("lang"), columns.get("source", "a"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def test_kdtree_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(400, 6)).round(2))]
    rows += [(400 + i, rows[0][1]) for i in range(30)] + [(500, None), (501, [1.0, None] * 3), (502, [math.inf] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    found = kdtree.top_k(df, df.where("vec_id % 50 = 0"), shard_rows=64, query_rows=4)
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows[:430]}
    want = {(q, r + 1, i, s) for q in good if q % 50 == 0 for r, (s, i) in enumerate(sorted(
        ((int(good[q] @ v), i) for i, v in good.items() if i != q), key=lambda x: (-x[0], x[1]))[:5])}
    assert {tuple(r) for r in found.collect()} == want
    assert kdtree.top_k(df.limit(0), df.limit(0)).count() == 0


def test_warc_round_trip(spark):
    long = "é" * 600
    rows = [(1, "http://a/\r\nx", long), (5, "u", long), (3, None, long), (2, "u", "small"), (4, "u", "small"),
            (6, "u", None), (None, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    archive = warc.write_archive(pages, scratch_path(spark, "warc"))
    found = {r.page_id: r for r in warc.read_records(archive, spark).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in found.items()} == {
        1: ("revisit", 5), 3: ("revisit", 5), None: ("revisit", 5), 5: ("response", None), 2: ("response", None),
        4: ("response", None), 6: ("response", None)}
    assert {i: bytes(r.payload).decode() for i, r in found.items()} == {i: h or "" for i, _, h in rows}
    assert all(r.payload_digest == r.payload_sha1 == hashlib.sha1(bytes(r.payload)).hexdigest() for r in found.values())
    assert bytes(found[5].record).endswith(long.encode() + b"\r\n\r\n") and found[1].url == "http://a/%0D%0Ax"
    assert archive.payloads(spark).count() == 3
    path = scratch_path(spark, "files")
    warc.export_warc(archive, spark, path)
    whole = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    assert whole.count("WARC/1.1\r\n") == 7
    assert warc.write_archive(pages.limit(0), scratch_path(spark, "warc")).headers(spark).count() == 0


def test_url_rules_and_templates(spark):
    given = ["http://Example.ORG/en/1x", "http://a.example.org/es/", "http://org", "nothing", None,
             "http://x.com/fr/1?a#b", "ftp://com/de/1", "http://x.com/fr?/", "http://ÄB.net/a#/x", "http://evilorg/"]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("host", F.lit(0))
    found = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    assert [found[i].rule for i in range(10)] == [
        "example.org/en/1", "example.org/es/", None, None, None, "com/fr/", "com/de/", None, None, None]
    assert [found[i].verdict for i in (0, 1, 5, 6)] == ["block", "block", "allow", "block"]
    assert (found[4].host, found[4].path, found[8].host, found[8].path) == ("", "", "Äb.net", "/a")
    many = [(i, f"http://h.com/{'fr' if i % 2 else 'de'}/{i}") for i in range(40)] + [
        (100 + i, f"http://h.com/en/{i}") for i in range(9)] + [(200 + i, f"http://z.com/de/{i}") for i in range(30)] + [
        (300, "http://z.com/it/5")]
    found = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(many, "page_id long, url string")).collect()}
    assert len(found) == len(many) and found[100].template == "/*/{n}" and found[300].verdict == "block"
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_url_branches_merge_by_evidence_alone(spark):
    rules = (("block", "w.com/bad/"), ("allow", "w.com/s"), ("block", "d.com/a/b/c/d/e/f/g/x/"),
             ("allow", "d.com/a/b/c/d/e/f/g/y/"), ("block", "m.com/de/"), ("allow", "m.com/fr/"))
    letters = "abcdefghij"
    given = [f"http://w.com/s{letters[i // 10]}{letters[i % 10]}/{j}" for i in range(80) for j in range(4)]
    given += [f"http://w.com/bad/{j}" for j in range(12)]
    given += [f"http://d.com/a/b/c/d/e/f/g/{k}/{j}" for k in "xy" for j in range(20)]
    given += [f"http://m.com/{k}/{j}" for k in ("de", "fr", "en", "es") for j in range(20)]
    given += [f"http://u.com/{k}/p{letters[j]}" for k in ("ann", "bob", "cyd") for j in range(10)]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    rows = urls.filter_urls(pages, rules).collect()
    assert len(rows) == len(given)
    template = {given[r.page_id].split("//")[1]: r.template for r in rows}
    share = {given[r.page_id].split("//")[1]: r.share for r in rows}
    assert template["w.com/saa/0"] == template["w.com/shj/3"] == "/*/{n}" and template["w.com/bad/3"] == "/bad/{n}"
    assert share["w.com/bad/3"] > 0.5 > share["w.com/saa/0"]
    assert template["d.com/a/b/c/d/e/f/g/x/1"] == "/a/b/c/d/e/f/g/x/{n}" and share["d.com/a/b/c/d/e/f/g/y/1"] < 0.5
    assert (template["m.com/de/1"], template["m.com/fr/1"]) == ("/de/{n}", "/fr/{n}")
    assert template["m.com/en/1"] == template["m.com/es/1"] == "/*/{n}" and template["u.com/bob/pa"] == "/*/*"


def test_mixture_meets_its_target(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randint(1, 30)) if i % 9 else None, "en",
             ["big", "big", "big", "mid", "small", None][i % 6] if i > 20 else "big", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("tokens", F.lit("clash"))
    mix = mixing.Mix(entropy=0.99, repeats=3.0, block_tokens=50)
    found = mixing.mix_sources(docs, mix).collect()
    size, used, copies = {}, {}, {}
    for i, t, _, s, _ in rows:
        size[s or ""] = size.get(s or "", 0) + max(1, len((t or "").split()))
    for r in found:
        used[r.source] = used.get(r.source, 0) + r.tokens
        copies[r.row.doc_id] = copies.get(r.row.doc_id, 0) + 1
    weights = {r.source: r.weight for r in found}
    assert abs(sum(weights.values()) - 1) < 1e-6 and set(copies) == {r[0] for r in rows}
    budget = max(size[s] / weights[s] for s in size)
    for s in size:
        assert weights[s] * budget - 1 <= used[s] <= weights[s] * budget + 31
    epochs = {s: used[s] / size[s] for s in size}
    entropy = -sum(w * math.log(w) for w in weights.values()) / math.log(4)
    assert max(epochs.values()) <= 3.2 and (entropy >= 0.9899 or max(epochs.values()) > 2.9)
    assert found[0].row.asDict().keys() == {*docs.columns}
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_secrets_brute_force(spark):
    rng = random.Random(3)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    bits = ["token=token:abcdefghijklmn", "API_KEY = 'abc.def=ghi+jkl'", "AKIAABCDEFGHIJKLMN", "AKIA123", "é🙂", " ",
            "deadbeef" * 3, "0123456789abcdef0", key, "password:short", "secret:\"AAAAAAAAAAAAAAAA", "word", "\n", "f" * 30]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 8))) for _ in range(200)]
    docs = docs_of(spark, [*texts, None, "x" * 200_000 + " token=abcdefghijklmnop"]).withColumn("base", F.lit(1))
    found = {r.doc_id: r for r in secrets.secret_report(docs).collect()}
    pattern = r'''(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)'''
    for i, t in enumerate(texts):
        spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(pattern, t, re.A) if len(m[1]) >= 12]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        assert found[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (t, listed, found[i].spans)
        assert set(filter(None, listed.split(","))) <= set(found[i].spans.split(","))
        if f" {key} " in f" {t} ":
            assert "entropy:" in found[i].spans
    assert found[200].spans == "" and found[201].n_assign == 1
    clean = secrets.redact(docs).where("doc_id < 200").collect()
    assert all(not re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r.text) for r in clean)
    assert [r.text for r in secrets.redact(docs_of(spark, [None, "", "plain words"])).collect()] == [None, "", "plain words"]


def test_redaction_of_secrets_beside_allowed_pieces(spark):
    key = "q7Zr2WkX9bTn4LvJ6mYc8HsD1fPg"
    letters = "qWzRkXbTnLvJmYcHsDfPgQaU"
    gone = [key, f"example/{key}", f"2024-01-01-{key}", letters, f"EXAMPLE_{letters}", "A9F3C07BE1D82F64B5A0", "A9F3c07BE1D82f64B5A0C"]
    stay = ["abcdefgh/EXAMPLE/xxxx_XXXX", "2024-01-01/2024-01-02", "losasmentementemente", "EXAMPLE_EXAMPLE_EXAMPLE",
            "abcdefghijklmnopqrstuvwxyz", "keitstlichschenverpf"]
    texts = [f"see {t} there" for t in gone + stay]
    found = [r.text for r in secrets.redact(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert all("[SECRET]" in t and "there" in t and key not in t and letters not in t for t in found[:len(gone)])
    assert found[len(gone):] == texts[len(gone):]


def test_bpe_as_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    rng = random.Random(4)
    letters = "abcXY 'stdm\n\té漢🙂 _-<|endoftext|>019½"
    texts = ["", "<|endoftext|>a<|endoftext|>", "x" * 3000, " \n \n b", None] + [
        "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    path = public.path("byte_bpe_50k.json")
    docs = docs_of(spark, texts).withColumn("ids", F.lit(1))
    found = {r.doc_id: r.ids for r in bpe.encode_documents(docs, bpe.vocabulary(spark, path)).collect()}
    known = tokenizers.Tokenizer.from_file(path)
    coder = bpe.Codec(bpe.vocabulary(spark, path))
    for i, t in enumerate(texts):
        want = known.encode(t or "", add_special_tokens=False).ids
        assert found[i] == want and coder.decode(want) == known.decode(want, skip_special_tokens=False)
    assert bpe.encode_digest(docs.limit(0), bpe.vocabulary(spark, path)).count() == 0


def test_imatch_edges(spark):
    rng = random.Random(5)
    texts = [sentence(rng, 40) for _ in range(12)]
    docs = docs_of(spark, [*texts, texts[0], None, "", "Solo"]).withColumn("n", F.lit(1)).withColumn("mark", F.lit(1))
    docs = docs.union(docs.where("doc_id = 3"))
    found = {r.doc_id: r for r in imatch.fingerprint_documents(docs).collect()}
    assert len(found) == 16 and found[12].fingerprint == found[0].fingerprint
    assert found[13].fingerprint == found[14].fingerprint and found[13].n_chars == 0
    edited = texts[2][:len(texts[2]) - len(texts[2]) // 4] + texts[3][:len(texts[2]) // 4]
    assert found[2].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert found[15].edited_sha256 == hashlib.sha256(("Sol" + texts[0][:1]).encode()).hexdigest()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found.values())
    assert imatch.fingerprint_documents(docs.limit(0)).count() == 0


def test_language_profiles(spark):
    said = {"xx": "kala mika tolo puna", "yy": "strengh wrux zwolf"}
    rows = [(i, said[lang], lang, None, 0) for i, lang in enumerate(["xx", "yy"] * 20)]
    rows += [(100, "mika puna kala", None, None, 0), (101, None, "xx", None, 0), (102, "123 !?", "yy", None, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("lang_pred", F.lit("kept"))
    found = {r.doc_id: r for r in language.predict(docs.drop("lang_pred"), language.learned_profiles(docs)).collect()}
    assert found[100].lang_pred == "xx" and found[1].lang_pred == "yy" and 0 < found[1].score <= 1
    assert (found[101].lang_pred, found[101].score, found[102].lang_pred) == ("und", 0.0, "und")
    kept = language.spoken_documents(spark, docs, "")
    assert kept.columns == docs.columns and {r.lang_pred for r in kept.collect()} == {"kept"} and kept.count() == 41
    nobody = language.predict(docs.drop("lang_pred"), language.learn_profiles(docs.limit(0))).collect()
    assert {r.lang_pred for r in nobody} == {"und"}


def test_noise_and_unlearned_languages_go(spark):
    rng = random.Random(21)
    ends = {"xx": ["ka", "mi", "to", "lu", "na", "pe"], "yy": ["stren", "wrux", "zwol", "grif", "bram", "tch"],
            "zz": ["ñio", "éau", "què", "ôxe", "çav", "ïlh"]}
    speak = lambda lang, n: " ".join("".join(rng.choice(ends[lang]) for _ in range(rng.randint(1, 3)))
                                     for _ in range(n))
    noise = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
                               for _ in range(n))
    rows = [(i, speak("xx" if i % 2 else "yy", rng.choice([8, 40, 300])), "xx" if i % 2 else "yy", None, 0)
            for i in range(600)]
    rows += [(1000 + i, noise(n), None, None, 0) for i, n in enumerate([20, 50, 200, 1000, 3000] * 4)]
    rows += [(2000 + i, speak("zz", n), None, None, 0) for i, n in enumerate([20, 200, 1000] * 4)]
    kept = language.spoken_documents(spark, spark.createDataFrame(rows, DOCS), "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == list(range(600))


def test_profile_counts_brute_force():
    text = "Ab, ab-C é"
    grams, counts = language.counted(language.grams_of(text))
    unpack = lambda g: "".join(chr(int(g) >> s & (1 << 21) - 1) for s in (42, 21, 0)).lstrip("\0")
    words = ["ab", "ab", "c", "é"]
    want: dict = {}
    for w in words:
        for n in (1, 2, 3):
            padded = w if n == 1 else f" {w} "
            for i in range(len(padded) - n + 1):
                want[padded[i:i + n]] = want.get(padded[i:i + n], 0) + 1
    assert {unpack(g): int(c) for g, c in zip(grams, counts)} == want


def test_crf_marginals_brute_force():
    rng = np.random.default_rng(6)
    owner = np.repeat([0, 1, 2], [4, 1, 3])
    unary, steps = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs = quality.marginals(unary, owner, steps)
    want, joint = np.zeros(8), np.zeros((2, 2))
    for d in range(3):
        at = np.flatnonzero(owner == d)
        total = 0.0
        p, j = np.zeros(len(at)), np.zeros((2, 2))
        for code in range(2 ** len(at)):
            y = [code >> i & 1 for i in range(len(at))]
            w = math.exp(sum(unary[a] for a, v in zip(at, y) if v) + sum(steps[a, b] for a, b in zip(y, y[1:])))
            total += w
            p += w * np.array(y)
            for a, b in zip(y, y[1:]):
                j[a, b] += w
        want[at] = p / total
        joint += j / total
    assert np.allclose(good, want) and np.allclose(pairs, joint)


def test_quality_learns(spark):
    rng = random.Random(7)
    rows = [(i, "\n".join(sentence(rng, 8) + (" ### $$$" if i % 3 == 0 else ".") for _ in range(rng.randint(1, 5))),
             None, None, 0) for i in range(120)] + [(500, None, None, None, 0), (501, "", None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    model = quality.learn_quality(docs, labels)
    found = {r.doc_id: r.score for r in quality.score_documents(docs, model).collect()}
    assert sum((found[i] >= 0.3) == (i % 3 != 0) for i in range(120)) >= 118
    assert all(0 <= s <= 1 for s in found.values()) and found[500] == found[501]
    assert quality.learn_quality(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score_documents(docs.limit(3), None).collect()} == {0.5}


def test_quality_learns_from_whole_texts(spark, monkeypatch):
    rng = random.Random(17)
    rows = []
    for i in range(60):
        head = [sentence(rng, 6) + "." for _ in range(220)]
        tail = [sentence(rng, 6) + (" ### $$$ |||" if i % 2 else ".") for _ in range(220)]
        rows.append((i, "\n".join(head + tail), None, None, 0))
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    used = []
    monkeypatch.setattr(quality, "fit", lambda features, owner, labels: used.append((np.bincount(owner), labels)))
    for most in (400_000, 5_000, 1):
        monkeypatch.setattr(quality, "FIT_LINES", most, raising=False)
        quality.learn_quality(docs, labels)
    n = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60))
    assert [len(sizes) for sizes, _ in used][:2] == [n, 12] and len(used[2][0]) == 2
    assert all((sizes == 440).all() and set(found) == {0, 1} for sizes, found in used)


def test_near_duplicates_brute_force(spark):
    rng = random.Random(8)
    texts: list = []
    for _ in range(12):
        words = sentence(rng, 60).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = sentence(rng, 1)
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0], None, "", "one two", "One, two!", "?!"]
    docs = docs_of(spark, texts).withColumn("band", F.lit(1))
    docs = docs.union(docs.where("doc_id = 4"))
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    sets = []
    for t in texts:
        w = re.findall(r"[a-z0-9]+", (t or "").lower())
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(texts)))
    weak = set()
    for i in range(len(texts)):
        for j in range(i):
            like = len(sets[i] & sets[j]) / max(1, len(sets[i] | sets[j]))
            if like >= 0.8 or (texts[i] or "") == (texts[j] or ""):
                assert found[i] == found[j], (i, j, like)
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
            elif like >= 0.6:
                weak |= {i, j}
    assert all(found[i] == group[i] for i in range(len(texts)) if i not in weak and group[i] not in weak and found[i] not in weak)
    kept = neardup.single_documents(spark, docs, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(found.values()))
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_crowd_links_equal_pairwise():
    rng = random.Random(9)
    base = sentence(rng, 50).split()
    texts = []
    for _ in range(30):
        copy = base + base[:rng.randint(0, 12)]
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "zz"
        texts.append(" ".join(copy))
    common = (np.empty(0, np.uint64), np.empty(0))
    h, o, c = neardup.shingles_of(texts)
    sets = [(h[o == i], c[o == i]) for i in range(30)]
    labels = np.arange(30)
    every = np.arange(30)
    found = {tuple(sorted(p)) for p in neardup._crowd_links(texts, labels, every, every, common)}
    want = {(i, j) for i in range(30) for j in range(i + 1, 30)
            if max(neardup.weighted_jaccard(sets[i], sets[j], common)) >= 0.8}
    assert found == want and want


def test_document_frequencies_of_all_shingles(spark, monkeypatch):
    """A shingle of two of 300 documents weighs less than one of a single document, whatever blocks hold them."""
    monkeypatch.setattr(neardup, "BLOCK_CHARS", 2_000)
    monkeypatch.setattr(neardup, "HELD", 500)
    rng = random.Random(12)
    texts = [sentence(rng, rng.choice([0, 3, 40, 400])) for _ in range(260)]
    texts += [texts[i] + " " + sentence(rng, 20) for i in range(38)] + [None, "a b c d e " * 6]
    rows = docs_of(spark, texts).repartition(5).select("doc_id", F.lit(b"k").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    want: dict = {}
    for t in texts:
        for h in neardup.shingles_of([t or ""])[0].tolist():
            want[h] = want.get(h, 0) + 1
    assert {1, 2} <= set(want.values())
    found = neardup._signed(rows, 300, sum(len(t or "") for t in texts)).collect()
    assert sorted(r.doc_id for r in found) == list(range(300))
    for r in found:
        hashes, _, counts = neardup.shingles_of([texts[r.doc_id] or ""])
        seen = np.frombuffer(r.seen, np.int32)
        assert seen.tolist() == [want[h] for h in hashes.tolist()]
        known = np.sort(hashes), neardup.weights_of(seen, 300)
        assert r.bands == neardup.bands_of([texts[r.doc_id] or ""], known)[0]
    assert neardup.weights_of(np.array([1, 300]), 300).tolist() == [1, 0.5]


def test_rare_shingles_weigh_by_frequency(spark):
    """Texts alike only in shingles that many others have are less alike by weight than by number."""
    rng = random.Random(13)
    shared = sentence(rng, 40)
    texts = [shared + " " + sentence(rng, 9) for _ in range(2)] + [sentence(rng, 60) for _ in range(600)]
    rows = docs_of(spark, texts).select("doc_id", F.lit(b"k").alias("key"), "text")
    signed = neardup._signed(rows, len(texts), sum(map(len, texts))).join(rows.drop("key"), "doc_id").where(
        "doc_id < 2").select(F.col("doc_id").alias("node"), "text", "seen")
    pair = spark.createDataFrame([(0, 1)], "left long, right long")
    _, _, weighted, plain = neardup._verify(pair, signed, len(texts)).first()
    low = 1 - 0.5 * math.log(2) / math.log(602)
    assert weighted == pytest.approx(36 * low / (36 * low + 18)) and plain == pytest.approx(36 / 54)


@pytest.mark.parametrize("labels_of", [lambda i: 0 if i < 28 else i, lambda i: i % 3, lambda i: i, lambda i: 0])
def test_links_across_blocks_equal_pairwise(spark, monkeypatch, labels_of):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(11)
    base = sentence(rng, 50).split()
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = "zz"
        texts.append(" ".join(copy))
    common = (np.empty(0, np.uint64), np.empty(0))
    h, o, c = neardup.shingles_of(texts)
    sets = [(h[o == i], c[o == i]) for i in range(40)]
    crowds = spark.createDataFrame([(7, i, labels_of(i)) for i in range(40)], "hub long, node long, label long")
    table = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    found = neardup._links_across(crowds, table, spark.sparkContext.broadcast(common)).collect()
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if labels_of(i) != labels_of(j)
            and max(neardup.weighted_jaccard(sets[i], sets[j], common)) >= 0.8}
    assert {tuple(r) for r in found} == want and (want or labels_of(1) == labels_of(39))


def test_consistent_samples_agree_with_weighted_jaccard():
    rng = random.Random(10)
    common = (np.empty(0, np.uint64), np.empty(0))
    agreed, likeness = 0, 0.0
    for _ in range(60):
        words = sentence(rng, 80).split()
        other = words[:]
        for _ in range(3):
            other[rng.randrange(80)] = "q" + str(rng.random())
        texts = [" ".join(words), " ".join(other)]
        h, o, c = neardup.shingles_of(texts)
        j = neardup.weighted_jaccard((h[o == 0], c[o == 0]), (h[o == 1], c[o == 1]), common)[0]
        a, b = neardup.bands_of(texts, common)
        agreed += sum(x == y for x, y in zip(a, b))
        likeness += 20 * j ** 4
    assert abs(agreed - likeness) < 6 * math.sqrt(likeness)
