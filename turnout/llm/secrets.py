"""Secret scans: fixed kinds by pattern, others by entropy in sliding windows.

The entropy method looks at runs of token characters. A window slides over a
run; the counts of its characters change by the one that enters and the one
that leaves, and with them the sum of c*log2(c), kept in whole millionths so
that nothing drifts. Windows of hexadecimal runs, of runs with digits and of
letters alone have their own length and threshold. Runs that consist of allowed
pieces are passed over. The query and redaction go by the same rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnout.llm.common import table, text_of
from turnout.llm.registry import query

#: Fixed values of the query's contract: kind, pattern, least length of what counts.
ASSIGN = ("(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
          "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
#: What stands before group 2 in a match of ASSIGN.
ASSIGN_HEAD = ("^(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
               "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?")
#: Runs that are no secrets: digits only, and documented examples that make up the whole run. The latter
#: are taken out piece by piece: one pattern for a whole run would overflow the stack on long ones.
ALLOW = "^[0-9/_=+-]+$"
PIECES = ("EXAMPLE|example|xxxx|XXXX|0123456789|abcdefghijklmnopqrstuvwxyz|abcdefgh"
          "|ABCDEFGHIJKLMNOPQRSTUVWXYZ|[/_=+-]")


@dataclass(frozen=True)
class CharacterClass:
    """``pattern`` decides whether a run belongs to the class; the first that fits holds.

    With ``shrinks`` a run shorter than the window is one window, with the same
    share of the most bits that its length can have.
    """

    pattern: str
    window: int
    bits: float
    shrinks: bool = False


LEAST_RUN = 20
CLASSES = (CharacterClass("^[0-9a-fA-F]+$", 24, 3.05, shrinks=True), CharacterClass("[0-9]", 20, 3.55),
           CharacterClass("[A-Za-z]", 20, 3.6))
RUN = f"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"


def _placed(text: Column, pattern: str, kind: str, least: int, core=lambda m: m) -> tuple[Column, Column]:
    """Spans (start, order, end, kind, found) of leftmost matches whose core has ``least`` characters.

    The pieces between matches and the matches themselves alternate, so starts
    are running sums of their lengths. Texts without a possible match skip it.
    """
    order = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    sizes = F.transform(found, lambda m: F.length(m))
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,found:string>>")
    walked = F.aggregate(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), sizes.alias("size"), found.alias("m")),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(F.length(core(x["m"])) >= least, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), F.lit(order).alias("ord"),
                (acc["at"] + x["gap"] + x["size"]).alias("end"), F.lit(kind).alias("kind"),
                x["m"].alias("found"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return walked, empty


def _spans(text: Column, pattern: str, kind: str, least: int, guard: str, core=lambda m: m) -> Column:
    walked, empty = _placed(text, pattern, kind, least, core)
    return F.when(text.rlike(guard), walked).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, by start and then kind."""
    assign = _spans(text, ASSIGN, "assign", 12, "[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]{12}",
                    lambda m: F.regexp_replace(m, ASSIGN_HEAD, ""))
    # a shorter run fails and nothing longer can start inside it, so the length is in the pattern
    access = _spans(text, "AKIA[A-Z0-9]{14,}", "access", 18, "AKIA[A-Z0-9]{14}")
    hexed = _spans(text, "[0-9a-f]{16,}", "hex", 16, "[0-9a-f]{16}")
    return F.array_sort(F.concat(assign, access, hexed))


def most_sum(window: int, bits: float) -> int:
    """Sum of c*log2(c), in millionths, up to which a window has at least ``bits``."""
    return int((math.log2(window) - bits) * window * 1e6)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def window_range(run: Column, window: Column, least_sum: Column) -> Column:
    """(first, last, n): offsets of the first and last window with a sum of at most ``least_sum``, and how many.

    A step counts, in the window before it, the character that leaves and the one
    that comes, so it costs a window's length and the whole is linear in the run's.
    """
    most = max(c.window for c in CLASSES)
    # c*log2(c) in millionths, by c
    parts = F.array(*[F.lit(round(c * math.log2(c) * 1e6) if c > 1 else 0).cast("long") for c in range(most + 2)])
    blank = F.struct(
        F.lit(0).cast("long").alias("total"), F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"), F.lit(0).alias("n"))

    def walk(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            before = F.slice(codes, F.greatest(i - window, F.lit(1)), F.least(i - 1, window))
            comes, goes = F.get(codes, i - 1), F.when(i > window, F.get(codes, i - window - 1)).otherwise(F.lit(-1))

            def changed(now: Column) -> Column:
                n_in, n_out = now["n_in"], now["n_out"]
                return F.when(now["comes"] == now["goes"], acc["total"]).otherwise(
                    acc["total"] + F.get(parts, n_in + 1) - F.get(parts, n_in)
                    + F.when(n_out > 0, F.get(parts, n_out - 1) - F.get(parts, n_out)).otherwise(F.lit(0).cast("long")))

            def counted(now: Column) -> Column:
                return F.struct(
                    now["comes"].alias("comes"), now["goes"].alias("goes"),
                    F.size(F.filter(now["before"], lambda c: c == now["comes"])).alias("n_in"),
                    F.size(F.filter(now["before"], lambda c: c == now["goes"])).alias("n_out"))

            def moved(total: Column) -> Column:
                high = (i >= window) & (total <= least_sum)
                return F.struct(
                    total.alias("total"),
                    F.when(high & acc["first"].isNull(), i - window).otherwise(acc["first"]).alias("first"),
                    F.when(high, i - window).otherwise(acc["last"]).alias("last"),
                    (acc["n"] + high.cast("int")).alias("n"))

            here = F.struct(before.alias("before"), comes.alias("comes"), goes.alias("goes"))
            return _bound(_bound(_bound(here, counted), changed), moved)

        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), blank, step,
                           lambda acc: F.struct(acc["first"], acc["last"], acc["n"]))

    return _bound(F.transform(F.split(run, ""), lambda c: F.ascii(c)), walk)


def entropy_spans(text: Column, classes=CLASSES) -> Column:
    """One span per run with windows of high entropy, from the first to the last of them."""
    runs, _ = _placed(text, RUN, "entropy", LEAST_RUN)
    runs = F.filter(runs, lambda r: ~r["found"].rlike(ALLOW) & (F.regexp_replace(r["found"], PIECES, "") != ""))

    def sized(r: Column) -> Column:
        window, least = F.lit(None).cast("int"), F.lit(None).cast("long")
        for c in reversed(classes):
            fits = r["found"].rlike(c.pattern)
            sizes = range(LEAST_RUN, c.window) if c.shrinks else ()
            least = F.when(fits, reduce(lambda rest, n: F.when(F.length(r["found"]) == n, F.lit(
                most_sum(n, c.bits * math.log2(n) / math.log2(c.window)))).otherwise(rest), sizes,
                F.lit(most_sum(c.window, c.bits)))).otherwise(least)
            window = F.when(fits, F.least(F.length(r["found"]), F.lit(c.window)) if c.shrinks
                            else F.lit(c.window)).otherwise(window)
        return F.struct(r["start"].alias("start"), r["found"].alias("found"), window.alias("size"),
                        least.cast("long").alias("least"))

    def scored(r: Column) -> Column:
        return F.struct(r["start"].alias("start"), window_range(r["found"], r["size"], r["least"]).alias("hit"),
                        r["size"].alias("size"))

    known_size = F.filter(F.transform(runs, sized), lambda r: r["size"].isNotNull())
    hits = F.filter(F.transform(known_size, scored), lambda r: r["hit"]["n"] > 0)
    spans = F.transform(hits, lambda r: F.struct(
        (r["start"] + r["hit"]["first"]).alias("start"), F.lit(3).alias("ord"),
        (r["start"] + r["hit"]["last"] + r["size"]).alias("end"), F.lit("entropy").alias("kind")))
    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    return F.when(text.rlike(RUN), spans).otherwise(none)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Adds to (doc_id, text) the columns ``base`` and ``extra``, arrays of (start, ord, end, kind).

    Null texts are empty and have no spans. Rows are judged one by one, so
    repeated ones give equal results and an empty table gives no rows. Only
    doc_id and text are read.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    slim = lambda spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"), s["kind"].alias("kind")))
    return rows.select("doc_id", "text", slim(base_spans(F.col("text"))).alias("base"),
                       entropy_spans(F.col("text")).alias("extra"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and spans per document, as the query returns them."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return find_secrets(docs).select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "extra"))).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark``; overlapping spans give one mark.

    All columns and rows stay; a null text stays null.
    """
    spans = F.array_sort(F.concat(
        F.transform(base_spans(text_of()), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))),
        F.transform(entropy_spans(text_of()), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    joined = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= s["start"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.get(acc, F.size(acc) - 1)["start"].alias("start"),
            F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end"))))).otherwise(
        F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    text = F.col("text")
    built = F.aggregate(joined, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.struct(
        s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                       F.lit(mark)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    maybe = text.rlike("[A-Za-z0-9+/_.=-]{12}")
    return docs.withColumn("text", F.when(maybe, built).otherwise(text))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, secrets replaced and n_chars counted anew."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


_KIND = """
{kind}_m AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '{pattern}')) AS m,
         unnest(list_transform(regexp_split_to_array(text, '{pattern}')[:-2], lambda p: length(p))) AS gap,
         generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS i
  FROM d WHERE regexp_matches(text, '{pattern}')),
{kind}_s AS (
  SELECT doc_id, m, '{kind}' AS kind, {ord} AS ord,
         sum(gap + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS s,
         sum(gap + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e
  FROM {kind}_m)"""


def _sql() -> str:
    quoted = lambda p: p.replace("'", "''")
    kinds = [("assign", ASSIGN, 0), ("access", ACCESS, 1), ("hex", HEX, 2),
             ("entropy", RUN, 3)]
    parts = ",".join(_KIND.format(kind=k, pattern=quoted(p), ord=o) for k, p, o in kinds)
    allowed = f"NOT regexp_matches(m, '{ALLOW}') AND regexp_replace(m, '{PIECES}', '', 'g') <> ''"
    hexed, mixed, letters = CLASSES
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),{parts},
runs AS (
  SELECT *, CASE WHEN regexp_matches(m, '{hexed.pattern}') THEN least({hexed.window}, length(m))
                 WHEN regexp_matches(m, '{mixed.pattern}') THEN {mixed.window}
                 WHEN regexp_matches(m, '{letters.pattern}') THEN {letters.window} END AS w,
         CASE WHEN regexp_matches(m, '{hexed.pattern}')
                THEN {hexed.bits} * log2(least({hexed.window}, length(m))) / log2({hexed.window})
              WHEN regexp_matches(m, '{mixed.pattern}') THEN {mixed.bits} ELSE {letters.bits} END AS bits
  FROM entropy_s WHERE {allowed}),
windows AS (
  SELECT doc_id, s, m, w, bits, unnest(generate_series(0, length(m) - w)) AS o FROM runs WHERE w <= length(m)),
high AS (
  SELECT doc_id, s + min(o) AS s, s + max(o) + any_value(w) AS e FROM windows
  WHERE list_aggregate(string_split(substr(m, CAST(o + 1 AS INTEGER), w), ''), 'entropy') >= bits GROUP BY doc_id, windows.s),
base AS (
  SELECT doc_id, kind, ord, s, e FROM assign_s WHERE length(regexp_replace(m, '{quoted(ASSIGN_HEAD)}', '')) >= 12
  UNION ALL SELECT doc_id, kind, ord, s, e FROM access_s WHERE length(m) >= 18
  UNION ALL SELECT doc_id, kind, ord, s, e FROM hex_s WHERE length(m) >= 16),
spans AS (SELECT * FROM base UNION ALL SELECT doc_id, 'entropy', 3, s, e FROM high),
grouped AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (ord < 3), '') AS b,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN grouped USING (doc_id)
"""


@query("op2_secrets", _sql())
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of the documents."""
    return secret_report(table(spark, sf_dir, "documents"))
