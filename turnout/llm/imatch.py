"""Document fingerprints by I-Match with randomised lexicons.

Terms within a band of inverse document frequency, counted over distinct texts,
form the lexicon. It is dealt at random into subsets; for each subset a
document's distinct terms are sorted and hashed. Subsets come in rates: each
rate keeps a quarter of the terms of the one before, and a text is printed at
the first rate that leaves it few terms a subset, and at the next. Two
fingerprints are as alike as the share of subsets that both hash to the same
value, at the lowest rate that both have.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from turnout.llm.common import stored, table, text_of
from turnout.llm.registry import query
from turnout.session import scratch_path

TERM_GAP = r"[^\p{L}\p{N}]+"
HEX = 8
#: The level of a text without terms of the lexicon; far from all others.
BARE = -2
#: A lexicon of up to so many terms (16 bytes each) is broadcast, a larger one is joined by shuffle.
BROADCAST_TERMS = 500_000
#: Characters of text a bucket holds at least, most buckets, and ranges of ids dealt to a bucket.
BUCKET_CHARS = 32_000_000
MOST_BUCKETS = 50_000
RANGES = 8


@dataclass(frozen=True)
class Lexicon:
    """Terms with ``low`` <= ln(texts / texts holding the term) <= ``high``, in ``subsets`` subsets.

    A text is printed at a rate that leaves it ``crowd`` distinct terms a subset
    at most on average, in the lexicon or not. A lexicon has no more terms than
    exp(high) times the distinct terms of an average text, however many there are.
    """

    low: float = math.log(4)
    high: float = math.log(1000)
    subsets: int = 64
    crowd: int = 4

    def steps(self) -> list[int]:
        """Numbers of distinct terms above which a text takes the next rate; the last is beyond any array."""
        return [self.subsets * self.crowd * 4 ** i for i in range(12)]


def terms(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), TERM_GAP)), "")


def build_lexicon(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Hashes of the terms in the band, counted over all rows of ``texts``, which are distinct."""
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy(
        F.xxhash64("term").alias("hash")).agg(F.count(F.lit(1)).alias("df"))
    total = texts.agg(F.count(F.lit(1)).alias("total"))
    idf = F.round(F.log(F.col("total") / F.col("df")), 9)
    return counts.join(F.broadcast(total)).where(
        (idf >= round(lexicon.low, 9)) & (idf <= round(lexicon.high, 9))).select("hash")


def _at_rate(h: Column, level: Column, lexicon: Lexicon) -> Column:
    """Whether a term's hash falls into a subset of the rate; its subset is the same at all rates."""
    return F.pmod(h, F.call_function("shiftleft", F.lit(lexicon.subsets).cast("long"), level * 2)) < lexicon.subsets


def _places(every: Column, lexicon: Lexicon) -> Column:
    """One hash per subset of terms sorted by subset and term, empty where a subset has none."""
    # the one-element array binds the sorted terms once for all subsets
    return F.get(F.transform(F.array(every), lambda own: F.transform(
        F.sequence(F.lit(0), F.lit(lexicon.subsets - 1)), lambda k: F.coalesce(F.substring(F.md5(F.nullif(F.array_join(
            F.transform(F.filter(own, lambda x: x["k"] == k), lambda x: x["t"]), " "), F.lit(""))), 1, HEX), F.lit("")))), F.lit(0))


def fingerprint(found: Column, level: Column, mark: Column, lexicon: Lexicon) -> Column:
    """(level, fine, coarse): hashes of the subsets at a text's rate and at the next.

    ``found`` are the terms (h, t) of the lexicon at the text's rate. Without
    any, the level is BARE and the one place holds the digest of the text.
    """
    keyed = F.array_sort(F.transform(found, lambda x: F.struct(
        F.pmod(x["h"], F.lit(lexicon.subsets)).cast("int").alias("k"), x["t"].alias("t"), x["h"].alias("h"))))
    none = F.size(found) == 0
    return F.struct(
        F.when(none, F.lit(BARE)).otherwise(level).alias("level"),
        F.when(none, F.array(mark)).otherwise(_places(keyed, lexicon)).alias("fine"),
        F.when(none, F.array(F.lit(""))).otherwise(_places(
            F.filter(keyed, lambda x: _at_rate(x["h"], level + 1, lexicon)), lexicon)).alias("coarse"))


def likeness(left: Column, right: Column) -> Column:
    """Share of the places filled on either side that are equal, at the lower rate of the two.

    Texts whose rates are two steps or more apart differ in length too much to be alike: 0.
    """
    a = F.when(left["level"] >= right["level"], left["fine"]).otherwise(left["coarse"])
    b = F.when(right["level"] >= left["level"], right["fine"]).otherwise(right["coarse"])
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != "")), lambda x: x))
    filled = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != "") | (y != "")), lambda x: x))
    return F.when(F.abs(left["level"] - right["level"]) > 1, F.lit(0.0)).otherwise(
        equal / F.greatest(filled, F.lit(1)))


def shown(print_: Column) -> Column:
    def line(places: Column) -> Column:
        return F.array_join(F.transform(places, lambda x: F.when(x == "", "-" * HEX).otherwise(x)), "")
    return F.when(print_["level"] == BARE, F.get(print_["fine"], F.lit(0))).otherwise(
        F.concat_ws(":", print_["level"].cast("string"), line(print_["fine"]), line(print_["coarse"])))


def _ranges(slim: DataFrame, ranges: int) -> tuple[DataFrame, int]:
    """One row with the first ids of ranges of equal numbers of ids, in lists of ``width``, and that width."""
    lows = stored(slim.repartitionByRange(ranges, "doc_id").groupBy(
        F.spark_partition_id().alias("part")).agg(F.min("doc_id").alias("low")).select("low"), "id-ranges")
    width = math.isqrt(ranges) + 1
    every = lows.agg(F.array_sort(F.collect_list("low")).alias("lows"))
    groups = F.sequence(F.lit(0), F.ceil(F.size("lows") / F.lit(width)).cast("int") - 1)
    return every.select(F.size("lows").alias("parts"), F.when(F.size("lows") > 0, F.transform(
        groups, lambda i: F.slice("lows", i * width + 1, width))).alias("lists")), width


def _placed(rows: DataFrame, ranges: DataFrame, width: int) -> DataFrame:
    """Every row in the range of its id; the first id of a range also, as ``ghost``, at the end of the range before."""
    def last_up_to(values: Column) -> Column:
        return F.size(F.filter(values, lambda low: low <= F.col("doc_id"))) - 1

    columns = rows.columns
    group = rows.join(F.broadcast(ranges)).withColumn(
        "group", last_up_to(F.transform("lists", lambda x: F.get(x, F.lit(0)))))
    spot = group.withColumn("own", F.get("lists", F.col("group"))).withColumn("at", last_up_to(F.col("own")))
    part = F.col("group") * width + F.col("at")
    here = F.struct(part.alias("part"), F.lit(0).alias("ghost"))
    before = F.struct(F.pmod(part - 1, F.col("parts")).alias("part"), F.lit(1).alias("ghost"))
    return spot.select(*columns, F.explode(F.when(
        F.get("own", F.col("at")) == F.col("doc_id"), F.array(here, before)).otherwise(F.array(here))).alias("spot")).select(
        "spot.part", "spot.ghost", *columns)


def ordered_texts(docs: DataFrame) -> DataFrame:
    """(part, ghost, doc_id, mark, n, text, counted): texts in buckets of ranges of ids.

    Texts are shuffled once. What is known of them from (doc_id, mark) alone
    travels as rows of its own: which text of a repeated id stays, and which of
    several equal texts counts. The table is bucketed by range, so that windows
    over ranges and groups within them need no exchange.
    """
    spark = docs.sparkSession
    slim = stored(docs.select("doc_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("mark")).groupBy(
        "doc_id").agg(F.min(F.struct("n", "mark")).alias("own")).select("doc_id", "own.n", "own.mark"), "ids")
    chars = slim.agg(F.sum("n")).first()[0] or 0
    buckets = min(MOST_BUCKETS, chars // BUCKET_CHARS + 1)
    ranges, width = _ranges(slim, buckets * RANGES)
    counted = slim.groupBy("mark").agg(F.min("doc_id").alias("doc_id"))
    rows = docs.select("doc_id", F.md5("text").alias("mark"), "text", F.lit(0).alias("kept"), F.lit(0).alias("counted"))
    for known, count in ((slim, 0), (counted, 1)):
        rows = rows.unionByName(known.select(
            "doc_id", "mark", F.lit(None).cast("string").alias("text"), F.lit(1).alias("kept"), F.lit(count).alias("counted")))
    texts = _placed(rows, ranges, width).repartition(buckets, "part").groupBy("part", "ghost", "doc_id", "mark").agg(
        F.max("text").alias("text"), F.max("kept").alias("kept"), F.max("counted").alias("counted")).where("kept = 1").select(
        "part", "ghost", "doc_id", "mark", F.length("text").cast("long").alias("n"), "text", "counted")
    name = f"imatch_texts_{uuid4().hex}"
    texts.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, "texts")).bucketBy(
        buckets, "part").saveAsTable(name)
    return spark.table(name)


def fingerprint_documents(docs: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text ends in the beginning of the next document's, as the query's
    contract has it; a single document is its own next. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Null texts are empty. doc_id identifies a document: of rows repeating one the
    shortest text (then by digest) stays, rows with a null id have no place in
    the order and are left out. Equal texts count once for the lexicon. An empty
    table gives no rows. Only doc_id and text are read.
    """
    rows = docs.where(docs["doc_id"].isNotNull()).select(docs["doc_id"].cast("long").alias("doc_id"), text_of().alias("text"))
    texts = ordered_texts(rows)
    words = stored(build_lexicon(texts.where("ghost = 0 AND counted = 1"), lexicon), "lexicon")
    if words.count() <= BROADCAST_TERMS:
        words = F.broadcast(words)

    order = Window.partitionBy("part").orderBy("ghost", "doc_id")
    quarter = F.floor(F.lag("n").over(order) / 4).cast("int")
    heads = texts.select("part", "ghost", "doc_id", "mark", "n", "text", quarter.alias("quarter")).withColumn(
        "head", F.lead(F.substring("text", F.lit(1), F.col("quarter"))).over(order))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 4)).cast("int")),
                      F.coalesce("head", F.lit("")))
    own = ["part", "ghost", "doc_id", "n", "mark", "edited_sha256", "edited_mark"]
    sides = heads.select("part", "ghost", "doc_id", "n", "mark", "text", edited.alias("edited")).select(
        "part", "ghost", "doc_id", "n", "mark", F.sha2("edited", 256).alias("edited_sha256"),
        F.md5("edited").alias("edited_mark"), F.explode(F.array(
            F.struct(F.lit(0).alias("side"), terms(F.col("text")).alias("terms")),
            F.struct(F.lit(1).alias("side"), terms(F.col("edited")).alias("terms")))).alias("x"))
    level = reduce(lambda a, b: a + b, ((F.size("x.terms") > step).cast("int") for step in lexicon.steps()))
    coded = F.transform("x.terms", lambda t: F.struct(
        F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long").alias("h"), t.alias("t")))
    # an empty term, under a key of its own, keeps texts without any term of the lexicon
    used = sides.select(*own, "x.side", level.alias("level"), coded.alias("coded")).select(*own, "side", "level", F.explode(
        F.concat(F.array(F.struct(F.lit(-1).cast("long").alias("h"), F.lit("").alias("t"))),
                 F.filter("coded", lambda x: _at_rate(x["h"], F.col("level"), lexicon)))).alias("x")).withColumn(
        "hash", F.when(F.col("x.t") == "", F.xxhash64("doc_id", "side")).otherwise(F.xxhash64("x.t"))).join(
        words.withColumn("listed", F.lit(1)), "hash", "left").where("listed = 1 OR x.t = ''")

    def found(side: int) -> Column:
        return F.collect_set(F.when((F.col("side") == side) & (F.col("x.t") != ""), F.col("x")))

    prints = used.groupBy(*own).agg(
        found(0).alias("found"), found(1).alias("edited_found"),
        F.max(F.when(F.col("side") == 0, F.col("level"))).alias("level"),
        F.max(F.when(F.col("side") == 1, F.col("level"))).alias("edited_level")).select(
        *own, fingerprint(F.col("found"), F.col("level"), F.col("mark"), lexicon).alias("print"),
        fingerprint(F.col("edited_found"), F.col("edited_level"), F.col("edited_mark"), lexicon).alias("edited"))
    return prints.withColumn("next", F.lead("print").over(order)).where("ghost = 0").select(
        "doc_id", F.col("n").alias("n_chars"), "edited_sha256", shown(F.col("print")).alias("fingerprint"),
        shown(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited")).alias("near_edited"),
        likeness(F.col("print"), F.col("next")).alias("near_next"))


def _sql(lexicon: Lexicon = Lexicon()) -> str:
    gap = r"[^\p{L}\p{N}]+"
    empty = "-" * HEX
    level = " + ".join(f"(count(*) > {step})::INTEGER" for step in lexicon.steps())

    def prints(name: str, text: str, source: str) -> str:
        return f"""
{name}_t AS (
  SELECT * FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower({text}), '{gap}')) AS term FROM {source})
  WHERE term <> ''),
{name}_g AS (SELECT doc_id, {level} AS level FROM {name}_t GROUP BY doc_id),
{name}_k AS (
  SELECT doc_id, level, step, h % {lexicon.subsets} AS k, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, {HEX}) AS hash
  FROM (SELECT doc_id, level, term, ('0x' || substr(md5(term), 1, 8))::BIGINT AS h
        FROM {name}_t JOIN lexicon USING (term) JOIN {name}_g USING (doc_id))
  CROSS JOIN (SELECT unnest([0, 1]) AS step)
  WHERE h % ({lexicon.subsets}::BIGINT << (2 * (level + step))) < {lexicon.subsets} GROUP BY doc_id, level, step, k),
{name}_l AS (
  SELECT doc_id, coalesce(x.level, {BARE}) AS level, md5({text}) AS mark
  FROM {source} LEFT JOIN (SELECT DISTINCT doc_id, level FROM {name}_k) x USING (doc_id)),
{name}_all AS (
  SELECT l.doc_id, l.level, s.step, s.k, coalesce(x.hash, '') AS h
  FROM {name}_l l CROSS JOIN (SELECT unnest(range({lexicon.subsets})) AS k, 0 AS step UNION ALL
                              SELECT unnest(range({lexicon.subsets})), 1) s
  LEFT JOIN {name}_k x ON x.doc_id = l.doc_id AND x.step = s.step AND x.k = s.k WHERE l.level <> {BARE}),
{name}_f AS (
  SELECT doc_id, mark AS fp FROM {name}_l WHERE level = {BARE} UNION ALL
  SELECT doc_id, level || ':' || string_agg(CASE WHEN h = '' THEN '{empty}' ELSE h END, '' ORDER BY k) FILTER (step = 0)
         || ':' || string_agg(CASE WHEN h = '' THEN '{empty}' ELSE h END, '' ORDER BY k) FILTER (step = 1)
  FROM {name}_all GROUP BY doc_id, level)"""

    def near(name: str, other: str, key: str) -> str:
        return f"""
{name}_shares AS (
  SELECT a.doc_id, count(*) FILTER (a.h = b.h AND a.h <> '') / greatest(count(*) FILTER (a.h <> '' OR b.h <> ''), 1) AS share
  FROM own_all a JOIN e USING (doc_id) JOIN {other}_all b ON b.doc_id = e.{key} AND b.k = a.k
  WHERE abs(a.level - b.level) <= 1 AND a.step = greatest(a.level, b.level) - a.level
    AND b.step = greatest(a.level, b.level) - b.level GROUP BY a.doc_id),
{name} AS (
  SELECT a.doc_id, CASE WHEN a.level = {BARE} AND b.level = {BARE} THEN (a.mark = b.mark)::INTEGER::DOUBLE
                        ELSE coalesce(share, 0.0) END AS {name}
  FROM own_l a JOIN e USING (doc_id) JOIN {other}_l b ON b.doc_id = e.{key} LEFT JOIN {name}_shares s ON s.doc_id = a.doc_id)"""

    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents),
o AS (
  SELECT *, coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id FROM d),
e AS (
  SELECT o.doc_id, o.n, o.next_id, o.text,
         substr(o.text, 1, o.n - o.n // 4) || substr(x.text, 1, o.n // 4) AS edited
  FROM o JOIN d x ON o.next_id = x.doc_id),
u AS (SELECT row_number() OVER () AS number, text FROM (SELECT DISTINCT text FROM d)),
counted AS (
  SELECT term, count(*) AS df FROM (
    SELECT DISTINCT number, unnest(regexp_split_to_array(lower(text), '{gap}')) AS term FROM u) WHERE term <> '' GROUP BY term),
lexicon AS (
  SELECT term FROM counted
  WHERE round(ln((SELECT count(*) FROM u) / df), 9) BETWEEN {round(lexicon.low, 9)} AND {round(lexicon.high, 9)}),
{prints('own', 'text', 'e')},
{prints('changed', 'edited', 'e')},
{near('near_edited', 'changed', 'doc_id')},
{near('near_next', 'own', 'next_id')}
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, own_f.fp AS fingerprint,
       changed_f.fp AS edited_fingerprint, near_edited, near_next
FROM e JOIN own_f USING (doc_id) JOIN changed_f USING (doc_id) JOIN near_edited USING (doc_id) JOIN near_next USING (doc_id)
"""


@query("op5_imatch", _sql())
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edits and their neighbours."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))
