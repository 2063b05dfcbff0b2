"""Phrase collocations by prefix-free parsing.

Every piece of text is parsed into chunks that end where the hash of two words
hits a trigger value; the next chunk begins with these two words. Equal
passages give equal chunks wherever they stand, so a dictionary of distinct
chunks with their frequencies stands for the whole corpus, and phrases are
counted inside the dictionary, weighted. A phrase of up to three words that
begins in the overlap belongs to the next chunk, so each is counted once.

Counts are found level by level. Phrases of n words are first counted by a hash
in ``HASH_BITS`` bits, only where both their parts of n - 1 words may be
frequent; collisions can only raise a count. The phrases themselves are then
grouped and counted exactly for those hashes that pass.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from turnout.llm.common import stored, table, text_of
from turnout.llm.registry import query
from turnout.llm.words import _powers, mix

WORDS = 3
LEAST = 10
#: One of so many pairs of words ends a chunk.
TRIGGER = 16
HASH_BITS = 48
#: A set of frequent hashes is a bitmap of 16 bits and more for each, up to 2^28 bits (32 MB).
BITMAP_BITS = 28
BUCKET = 32768
#: Bytes of text and words of chunks that are worked on at a time, hashes that are condensed at a time.
WINDOW = 1 << 20
TOKENS = 1 << 19
HELD = 1 << 21
HELD_CHUNKS = 1 << 16
PERCENT = 50
MOST = 2000
MILLION = 1_000_000
ODD = mix(np.arange(1, WORDS + 2, dtype=np.uint64)) | np.uint64(1)
#: Letters to lower case, ends of pieces to line ends, tabs to blanks.
FOLDED = bytes(ord("\n") if chr(b) in ".,;:!?\n\v\f\r" else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))


def windows(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """(part, whether its last piece goes on) of a folded text, parts of about ``WINDOW`` bytes.

    Parts end with a piece. A piece that is longer than a part is cut at a blank; its last
    two words are the first of the next part, as with any chunk.
    """
    start, held = 0, b""
    while start < len(text):
        line = text.find(b"\n", start + WINDOW)
        end = len(text) if line < 0 else line
        blank = text.find(b" ", start + WINDOW, end) if end - start > 2 * WINDOW else -1
        part = held + text[start:end if blank < 0 else blank]
        yield part, blank >= 0
        held = b""
        if blank >= 0:
            held = b" ".join(part[part.rfind(b"\n") + 1:].split()[1 - WORDS:]) + b" "
        start = (end if blank < 0 else blank) + 1


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, from running sums of their bytes."""
    power, inverse = _powers(1 << max(16, int(len(buffer) + 1).bit_length()))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[:len(buffer)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def chunks_of(text: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """Lists of chunks (words joined by blanks) of a folded text, and whether these end their pieces."""
    for part, goes_on in windows(text):
        buffer = np.frombuffer(part, np.uint8)
        line = buffer == 10
        gap = np.concatenate([[True], line | (buffer == 32), [True]])
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        starts, ends = edge[0::2], edge[1::2]
        if not len(starts):
            continue
        hashed = span_hashes(buffer, starts, ends)
        piece = np.cumsum(line)[starts]
        last = np.flatnonzero(np.concatenate([piece[1:] != piece[:-1], [True]])) + 1
        first = np.concatenate([[0], last[:-1]])
        number = np.repeat(np.arange(len(last)), last - first)[1:]
        at = np.arange(1, len(starts))
        hit = mix(hashed[:-1] * ODD[0] + hashed[1:] * ODD[1]) % np.uint64(TRIGGER) == 0
        # a chunk has more words than the overlap, and a piece's last word needs no trigger
        cut = at[hit & (at >= first[number] + 2) & (at < last[number] - 1)]
        chunk_ends = np.concatenate([cut + 1, last])
        closes = np.concatenate([np.zeros(len(cut), bool), np.ones(len(last), bool)])
        closes[-1] = not goes_on
        order = np.argsort(chunk_ends, kind="stable")
        chunk_starts, chunk_ends, closes = np.sort(np.concatenate([first, cut - 1])), chunk_ends[order], closes[order]
        # single blanks between all words of a chunk: it is a slice of the text
        begin, end = starts[chunk_starts], ends[chunk_ends - 1]
        letters = np.concatenate([[0], np.cumsum(ends - starts)])
        plain = letters[chunk_ends] - letters[chunk_starts] + chunk_ends - chunk_starts - 1 == end - begin
        for some in (closes, ~closes):
            yield [part[s:e] for s, e in zip(begin[some & plain].tolist(), end[some & plain].tolist())], bool(some is closes)
            yield [b" ".join(part[s:e].split()) for s, e in zip(
                begin[some & ~plain].tolist(), end[some & ~plain].tolist())], bool(some is closes)


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, size, closes, times): distinct chunks of all texts of a language and how often they occur."""
    names = ["lang", "chunk", "size", "closes", "times"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(lang: str, closes: bool, seen: Counter) -> pa.RecordBatch:
            n = len(seen)
            return pa.RecordBatch.from_arrays([
                pa.array([lang] * n, pa.string()), pa.array(seen, pa.binary(), size=n),
                pa.array((c.count(b" ") + 1 for c in seen), pa.int32(), size=n),
                pa.array([closes] * n, pa.bool_()), pa.array(seen.values(), pa.int64(), size=n)], names)

        seen: defaultdict[tuple[str, bool], Counter] = defaultdict(Counter)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts: defaultdict[str, list[bytes]] = defaultdict(list)
            for lang, text in zip(langs, batch.column(1).to_pylist()):
                texts[lang].append(text)
            for lang, some in texts.items():
                for chunks, closes in chunks_of(b"\n".join(some).translate(FOLDED)):
                    counted = seen[lang, closes]
                    counted.update(chunks)
                    if len(counted) >= HELD_CHUNKS:
                        yield out(lang, closes, seen.pop((lang, closes)))
        for (lang, closes), counted in seen.items():
            yield out(lang, closes, counted)

    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       text_of().cast("binary").alias("text"))
    return rows.mapInArrow(parse, "lang string, chunk binary, size int, closes boolean, times long").groupBy(
        "lang", "chunk", "size", "closes").agg(F.sum("times").alias("times"))


class Tokens:
    """Words of some rows of the dictionary, and the hashes of the phrases that begin at each."""

    def __init__(self, rows: pa.RecordBatch):
        tongue = rows.column(0).dictionary_encode()
        self.langs, self.lang = tongue.dictionary.to_pylist(), tongue.indices.to_numpy()
        self.chunks, size, closes, self.times = rows.column(1), *(
            rows.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        size = size.astype(np.int64)
        kind = np.int64 if pa.types.is_large_binary(self.chunks.type) else np.int32
        offsets = np.frombuffer(self.chunks.buffers()[1], kind)[self.chunks.offset:][:len(self.chunks) + 1].astype(np.int64)
        buffer = np.frombuffer(self.chunks.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets -= offsets[0]
        # words end at blanks and at the ends of chunks
        words, last = int(size.sum()), np.cumsum(size)
        blank = np.flatnonzero(buffer == 32)
        starts, ends = np.empty(words, np.int64), np.empty(words, np.int64)
        inner = np.ones(words, bool)
        inner[last - size] = False
        starts[last - size], starts[inner] = offsets[:-1], blank + 1
        inner = np.ones(words, bool)
        inner[last - 1] = False
        ends[last - 1], ends[inner] = offsets[1:], blank
        #: words up to the chunk's end, and whether a phrase that begins here is counted here
        self.left = np.repeat(last, size) - np.arange(words)
        self.own = np.repeat(closes, size) | (self.left > WORDS - 1)
        self.chunk = np.repeat(np.arange(len(size)), size)
        self.base = np.fromiter(map(xxhash.xxh64_intdigest, self.langs), np.uint64, len(self.langs))[self.lang] * ODD[WORDS]
        self.hashed = span_hashes(buffer, starts, ends)

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words, hashes) of all phrases of ``n`` words within chunks, overlaps included."""
        at = np.flatnonzero(self.left >= n)
        sums = self.base[self.chunk[at]]
        for j in range(n):
            sums += self.hashed[at + j] * ODD[j]
        return at, mix(sums + np.uint64(n)) >> np.uint64(64 - HASH_BITS)

    def possible(self, n: int, maps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``phrases`` counted here whose parts of one word less, if any, may all be frequent."""
        at, hashes = self.phrases(n)
        keep = self.own[at]
        if n > 1:
            part, part_hashes = self.phrases(n - 1)
            may = np.zeros(len(self.left) + 1, bool)
            may[part] = holds(maps[n - 2], part_hashes)
            keep = keep & may[at] & may[at + 1]
        return at[keep], hashes[keep]


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set that ``bits`` was made of."""
    place = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    """Rows of the dictionary in parts of about ``TOKENS`` words."""
    held: list[pa.RecordBatch] = []
    words = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            words += pc.sum(batch.column(2)).as_py()
        if words >= TOKENS:
            yield Tokens(pa.concat_batches(held))
            held, words = [], 0
    if held:
        yield Tokens(pa.concat_batches(held))


def frequent_hashes(chunks: DataFrame, n: int, least: int, maps) -> DataFrame:
    """Hashes of phrases of ``n`` words with ``least`` occurrences or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def condensed() -> tuple[np.ndarray, np.ndarray]:
            hashes, times = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(hashes)
            hashes = hashes[order]
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            return hashes[first], np.add.reduceat(times[order], first)

        def out() -> pa.RecordBatch:
            hashes, times = condensed()
            return pa.RecordBatch.from_pydict({"hash": hashes.astype(np.int64), "times": times})

        for tokens in tokens_of(batches):
            at, hashes = tokens.possible(n, maps.value)
            if len(at):
                held.append((hashes, tokens.times[tokens.chunk[at]]))
            if sum(len(x[0]) for x in held) > HELD:
                yield out()
                held = []
        if held:
            yield out()

    return chunks.mapInArrow(count, "hash long, times long").groupBy("hash").agg(
        F.sum("times").alias("times")).where(F.col("times") >= least).select("hash")


def bitmap(hashes: DataFrame) -> np.ndarray:
    """A set of hashes as bits, addressed by their lowest ones; its size is bounded by ``BITMAP_BITS``."""
    bits = min(BITMAP_BITS, max(15, (16 * hashes.count()).bit_length()))
    place = F.col("hash").bitwiseAND((1 << bits) - 1)
    rows = hashes.select(place.alias("place")).groupBy(
        F.shiftright("place", 15).alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(place & {BUCKET - 1})").alias("bits"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for bucket, part in rows.toLocalIterator():
        out[bucket * BUCKET // 8:(bucket + 1) * BUCKET // 8] = np.frombuffer(part, np.uint8)
    return out


def frequent_phrases(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, times): all phrases of up to ``WORDS`` words with ``least`` occurrences or more."""
    context = chunks.sparkSession.sparkContext
    maps: list[np.ndarray] = []
    for n in range(1, WORDS + 1):
        maps.append(bitmap(stored(frequent_hashes(chunks, n, least, context.broadcast(list(maps))), "frequent-hashes")))
    known = context.broadcast(maps)
    names = ["lang", "phrase", "words", "times"]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in tokens_of(batches):
            # numbers of words, languages and word sequences stand for them exactly
            known_words: dict[bytes, int] = {}
            words = b" ".join(tokens.chunks.to_pylist()).split(b" ")
            ids = np.fromiter((known_words.setdefault(w, len(known_words)) for w in words), np.int64, len(words))
            word, many = list(known_words), len(known_words)
            for n in range(1, WORDS + 1):
                at, hashes = tokens.possible(n, known.value)
                at = at[holds(known.value[n - 1], hashes)]
                if not len(at):
                    continue
                keys = tokens.lang[tokens.chunk[at]].astype(np.int64)
                for j in range(n):
                    keys = np.unique(keys, return_inverse=True)[1] * many + ids[at + j]
                order = np.argsort(keys)
                first = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
                times = np.add.reduceat(tokens.times[tokens.chunk[at]][order], first)
                at = at[order[first]]
                parts = [[word[i] for i in ids[at + j].tolist()] for j in range(n)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(tokens.langs, pa.string()).take(pa.array(tokens.lang[tokens.chunk[at]])),
                    pa.array(map(b" ".join, zip(*parts)), pa.binary()),
                    pa.array(np.full(len(at), n, np.int32)), pa.array(times)], names)

    return chunks.mapInArrow(spell, "lang string, phrase binary, words int, times long").groupBy(
        "lang", "phrase", "words").agg(F.sum("times").alias("times")).where(F.col("times") >= least).select(
        "lang", F.col("phrase").cast("string").alias("phrase"), "words", "times")


def collocations(docs: DataFrame, least: int = LEAST, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """The best collocations of every language of ``docs`` (text, lang; other columns are not read).

    Texts are lower-cased (A-Z) and split into pieces at ``. , ; : ! ?`` and
    the control characters 10 to 13, pieces into words at blanks and tabs.
    Null texts are empty, a null language is ``und``; rows repeated count again.
    A phrase of two or three words with ``least`` occurrences a is scored
    a * a / (l * r) for the parts of a cut, in millionths, rounded down; its
    lowest cut counts, the first of equal ones. A phrase of two words inside one
    of three is left out if that has ``percent`` of its occurrences or more. Of
    each language the ``most`` highest scores are returned, ties by more
    occurrences, then by the phrase's bytes: lang, rank, phrase, a, l, r, n (all
    words of the language), score. An empty table gives no rows.
    """
    chunks = stored(dictionary(docs), "chunks")
    words = chunks.groupBy("lang").agg(F.sum(F.col("times") * F.when(
        F.col("closes"), F.col("size")).otherwise(F.col("size") - (WORDS - 1))).alias("n"))
    phrases = stored(frequent_phrases(chunks, least), "phrases")

    long = phrases.where(F.col("words") > 1)
    cuts = stored(long.select(
        "lang", "phrase", F.col("times").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).select("*", F.expr("substring_index(phrase, ' ', k)").alias("head"),
             F.expr("substring_index(phrase, ' ', k - words)").alias("tail")), "cuts")
    heads = phrases.select(F.col("lang").alias("head_lang"), F.col("phrase").alias("head_phrase"), F.col("times").alias("l"))
    tails = phrases.select(F.col("lang").alias("tail_lang"), F.col("phrase").alias("tail_phrase"), F.col("times").alias("r"))
    parted = cuts.join(heads, (cuts.lang == heads.head_lang) & (cuts["head"] == heads.head_phrase)).join(
        tails, (cuts.lang == tails.tail_lang) & (cuts["tail"] == tails.tail_phrase))
    # exact: a is at most l and r, so a score is a million at most; products have up to 37 digits
    exact = {x: F.col(x).cast("decimal(15,0)") for x in "alr"}
    score = F.call_function("div", exact["a"] * exact["a"] * F.lit(MILLION).cast("decimal(7,0)"), exact["l"] * exact["r"])
    scored = parted.withColumn("score", score).groupBy("lang", "phrase", "a", "words").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # the pairs inside frequent phrases of three words, with the most frequent of these
    inside = long.where(F.col("words") == WORDS).select("lang", "times", F.explode(F.array(
        F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("part")).groupBy("lang", "part").agg(
        F.max("times").alias("longer")).select(F.col("lang").alias("part_lang"), "part", "longer")
    kept = scored.join(inside, (scored.lang == inside.part_lang) & (scored.phrase == inside.part), "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= most)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
spoken AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words, count(*) AS times FROM pieces GROUP BY 1, 2),
counted AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, CAST(sum(times) AS BIGINT) AS f
  FROM (SELECT lang, words, times, size, unnest(generate_series(1, len(words) - size + 1)) AS i
        FROM spoken, (VALUES (1), (2), (3)) AS s(size))
  GROUP BY 1, 2, 3),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY 1),
frequent AS (SELECT * FROM counted WHERE f >= 10),
cuts AS (
  SELECT lang, phrase, f AS a, size, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS tail
  FROM frequent, (VALUES (1), (2)) AS t(k) WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.size, h.f AS l, t.f AS r, CAST(
    (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY
      (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(h.f AS HUGEINT) * t.f), c.k) AS place
  FROM cuts c JOIN counted h ON c.lang = h.lang AND c.head = h.phrase
    JOIN counted t ON c.lang = t.lang AND c.tail = t.phrase
  QUALIFY place = 1),
inside AS (
  SELECT lang, part, max(f) AS longer FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                            array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS part
    FROM frequent WHERE size = 3) GROUP BY 1, 2),
ranked AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score, row_number() OVER (
    PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON s.lang = i.lang AND s.phrase = i.part
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON r.lang = t.lang WHERE r.rank <= 2000
"""


@query("op13_phrases", _SQL)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    return collocations(table(spark, sf_dir, "documents"))
