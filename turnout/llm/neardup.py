"""Near duplicates by improved consistent weighted sampling of TF-IDF shingles.

Shingles of five words weigh their count in the text times an inverse document
frequency, which is counted for every shingle over all documents. Each of ``SAMPLES`` hash functions samples one shingle (and the level
of its weight) so that two texts agree on a sample with the probability of
their weighted Jaccard similarity. Samples are put into bands; texts that share
a band meet in a bucket, are compared to the bucket's hub and then, where the
bucket holds more than one group, to the members of other groups. Compared
pairs are verified on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from turnout.llm.common import stored, table, text_of
from turnout.llm.registry import query
from turnout.llm.words import mix, text_parts, words_of

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
SAMPLES = BANDS * ROWS
#: Characters of a block of documents, about; shingles are exchanged by block.
BLOCK_CHARS = 8_000_000
#: Shingles that a task holds while it looks through texts, and those of one range of hashes.
HELD = 1_000_000
#: Characters of text to a shingle, about; only the number of ranges depends on it.
SHINGLE_CHARS = 5
#: Members of a block when groups under one hub are compared.
BLOCK = 512
ODD = mix(np.arange(1, SAMPLES + WORDS + 2, dtype=np.uint64)) | np.uint64(1)
TABLE = 16


def shingles_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, owner, count) of distinct shingles, by owner; a text of fewer words has one of all of them."""
    words, owner = words_of(texts)
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    whole = np.zeros(max(0, len(words) - WORDS + 1), dtype=np.uint64)
    for j in range(WORDS):
        whole += words[j:len(words) - WORDS + 1 + j] * ODD[j] if len(whole) else whole
    inside = owner[:len(whole)] == owner[WORDS - 1:] if len(whole) else np.empty(0, bool)
    hashes, owners = mix(whole[inside]), owner[:len(whole)][inside]
    sizes = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(sizes) - sizes
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    if len(short):
        added = [mix((words[first[i]:first[i] + sizes[i]] * ODD[:sizes[i]]).sum(keepdims=True)
                     + np.uint64(sizes[i]))[0] for i in short]
        hashes, owners = np.append(hashes, np.array(added, np.uint64)), np.append(owners, short)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])]))
    return hashes[new], owners[new], np.diff(np.append(new, len(hashes)))


def idf(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Weights from a table: ``common`` has sorted hashes and their weights, all others weigh 1."""
    known, weights = common
    out = np.ones(len(hashes))
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        out[hit] = weights[at[hit]]
    return out


def weights_of(seen: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequencies of shingles that ``seen`` of all documents have.

    The weight falls with the logarithm of the frequency, from 1 for a shingle of one document
    to one half for a shingle of every document.
    """
    return 1 - 0.5 * np.log(np.maximum(seen, 1)) / np.log(max(documents, 2))


@lru_cache(maxsize=1)
def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """r, log c and beta of consistent weighted sampling by table place, and the packed log a for weight 1."""
    places = np.arange(1 << TABLE, dtype=np.uint64)
    unit = [(mix(places * np.uint64(8) + np.uint64(j) + ODD[0]).astype(np.float64) + 1) / 2.0 ** 64
            for j in range(5)]
    unit = [np.clip(u, 1e-12, 1 - 1e-12) for u in unit]
    r, c, beta = -np.log(unit[0] * unit[1]), -np.log(unit[2] * unit[3]), unit[4]
    return r, np.log(c), beta, packed(np.log(c) + r * beta - r)


def packed(value: np.ndarray) -> np.ndarray:
    """Floats as upper 32 bits that sort alike."""
    bits = value.astype(np.float32).view(np.uint32)
    bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
    return bits.astype(np.uint64) << np.uint64(32)


def bands_of(texts: list[str], common: tuple[np.ndarray, np.ndarray]) -> list[list[int] | None]:
    """Band keys of every text; None for a text without words."""
    hashes, owners, counts = shingles_of(texts)
    return _bands(hashes, owners, counts * idf(hashes, common), len(texts))


def _bands(hashes: np.ndarray, owners: np.ndarray, weights: np.ndarray, texts: int) -> list[list[int] | None]:
    """Band keys of every text from its shingles with their weights."""
    if not len(hashes):
        return [None] * texts
    other = np.flatnonzero(weights != 1.0)
    log_w = np.log(weights[other])
    r, log_c, beta, plain = draws()
    low = hashes & np.uint64(0xFFFFFFFF)
    first = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
    keys = np.zeros((BANDS, len(first)), dtype=np.uint64)
    for k in range(SAMPLES):
        place = (hashes * ODD[k]) >> np.uint64(64 - TABLE)
        value = plain[place] | low
        if len(other):
            at = place[other]
            level = np.floor(log_w / r[at] + beta[at])
            key = (low[other] + level.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
            value[other] = packed(log_c[at] - r[at] * (level - beta[at]) - r[at]) | key
        sample = np.minimum.reduceat(value, first)
        keys[k // ROWS] += mix(sample) * ODD[k]
    keys = mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None]).view(np.int64)
    out: list[list[int] | None] = [None] * texts
    for i, key in zip(owners[first].tolist(), keys.T.tolist()):
        out[i] = key
    return out


def weighted_jaccard(left: tuple, right: tuple, common: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """(TF-IDF weighted, plain set) Jaccard of two texts' (hashes, counts)."""
    return _jaccard((*left, idf(left[0], common)), (*right, idf(right[0], common)))


def _jaccard(left: tuple, right: tuple) -> tuple[float, float]:
    """(weighted, plain set) Jaccard of two texts' (hashes, counts, weights)."""
    every = np.union1d(left[0], right[0])
    if not len(every):
        return 0.0, 0.0
    a, b, weight = np.zeros(len(every)), np.zeros(len(every)), np.zeros(len(every))
    for side, (hashes, counts, weights) in ((a, left), (b, right)):
        at = np.searchsorted(every, hashes)
        side[at], weight[at] = counts, weights
    return (float((np.minimum(a, b) * weight).sum() / (np.maximum(a, b) * weight).sum()),
            float(((a > 0) & (b > 0)).sum() / len(every)))


def _numbers(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """Numbers of all binary values of a column, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)


def _hashes(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The hashes of every value that ``_planes`` wrote."""
    return [np.frombuffer(v, np.uint8).reshape(8, -1).T.copy().view(np.uint64)[:, 0] for v in column.to_pylist()]


def _planes(hashes: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Sorted hashes from one edge to the next as binary: first bytes first, as those are alike and pack well."""
    return pa.array([hashes[a:b, None].view(np.uint8).T.tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values: ``values`` from one edge to the next."""
    return pa.array([values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())


def _in_blocks(rows: DataFrame, chars: int) -> DataFrame:
    """``rows`` (doc_id, key, text) with a ``block`` of about ``BLOCK_CHARS`` of all ``chars``, brought together by it."""
    blocks = F.lit(max(1, chars // BLOCK_CHARS))
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), blocks)).repartition("block")


def document_frequencies(rows: DataFrame, chars: int) -> DataFrame:
    """(block, shingles, seen): in how many of all ``rows`` (block, text) the shingles of a block are, exactly.

    Both are binary, 64-bit hashes and 32-bit numbers; shingles of one document only are left out.
    A block's shingles are sent, each once with the block's own number, to the range of hashes
    they lie in. There the numbers of all blocks are added, and each block is answered.
    """
    bits = max(1, int(chars // SHINGLE_CHARS // HELD).bit_length())

    def pieces(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, blocks = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((hashes, blocks))
        hashes, blocks = hashes[order], blocks[order]
        new = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (blocks[1:] != blocks[:-1])]))
        seen = np.diff(np.append(new, len(hashes))).astype(np.int32)
        hashes, blocks = hashes[new], blocks[new]
        ranges = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.append(np.flatnonzero(np.concatenate(
            [[True], (ranges[1:] != ranges[:-1]) | (blocks[1:] != blocks[:-1])])), len(hashes))
        return pa.RecordBatch.from_arrays(
            [pa.array(ranges[edges[:-1]]), pa.array(blocks[edges[:-1]]), _planes(hashes, edges), _cut(seen, edges)],
            ["range", "block", "shingles", "seen"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for part, texts in text_parts(batch):
                hashes, owners, _ = shingles_of(texts)
                if len(hashes):
                    held.append((hashes, part.column("block").to_numpy()[owners]))
                    n += len(hashes)
                if n >= HELD:
                    yield pieces(held)
                    held, n = [], 0
            if held:
                yield pieces(held)

    def added(group: pa.Table) -> pa.Table:
        parts, seen = _hashes(group.column("shingles")), _numbers(group.column("seen"), np.int32)
        hashes = np.concatenate(parts)
        order = np.argsort(hashes)
        new = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
        total = np.empty(len(hashes), np.int64)
        total[order] = np.repeat(np.add.reduceat(seen[order], new, dtype=np.int64), np.diff(np.append(new, len(hashes))))
        shared = total > 1
        edges = np.concatenate([[0], np.cumsum(shared)])[np.cumsum([0, *map(len, parts)])]
        return pa.table({"block": group.column("block"), "shingles": _planes(hashes[shared], edges),
                         "seen": _cut(total[shared].astype(np.int32), edges)})

    # all columns, so that the rows are brought together once for this and for the answers
    return rows.mapInArrow(
        local, "range long, block long, shingles binary, seen binary").groupBy("range").applyInArrow(
        added, "block long, shingles binary, seen binary").where("length(seen) > 0")


SIGNED = "doc_id long, key binary, bands array<long>, seen binary"


def _signed(rows: DataFrame, documents: int, chars: int) -> DataFrame:
    """(doc_id, key, bands, seen) of ``rows`` (doc_id, key, text): band keys and the document frequencies of all
    shingles, sorted by hash."""
    names = [field.split(" ")[0] for field in SIGNED.split(", ")]

    def sign(docs: pa.Table, frequent: pa.Table) -> pa.Table:
        known, first = np.unique(np.concatenate([np.empty(0, np.uint64), *_hashes(frequent.column("shingles"))]),
                                 return_index=True)
        common = known, _numbers(frequent.column("seen"), np.int32)[first]
        out = []
        for batch in docs.select(["doc_id", "key", "text"]).combine_chunks().to_batches():
            for part, texts in text_parts(batch):
                hashes, owners, counts = shingles_of(texts)
                found = idf(hashes, common).astype(np.int32)
                edges = np.searchsorted(owners, np.arange(len(texts) + 1))
                bands = _bands(hashes, owners, counts * weights_of(found, documents), len(texts))
                out.append(pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(bands, pa.list_(pa.int64())),
                     _cut(found, edges)], names))
        return pa.Table.from_batches(out)

    rows = _in_blocks(rows, chars)
    frequent = document_frequencies(rows, chars)
    return rows.groupBy("block").cogroup(frequent.groupBy("block")).applyInArrow(sign, SIGNED)


def _verify(pairs: DataFrame, texts: DataFrame, documents: int) -> DataFrame:
    """Pairs (left, right) with the weighted and plain similarity of their whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                both = [*part.column(2).to_pylist(), *part.column(3).to_pylist()]
                seen = dict(zip(both, [*part.column(4).to_pylist(), *part.column(5).to_pylist()]))
                place = {t: i for i, t in enumerate(seen)}
                hashes, owners, counts = shingles_of(list(place))
                weights = weights_of(np.frombuffer(b"".join(seen.values()), np.int32), documents)
                edges = np.searchsorted(owners, np.arange(len(place) + 1))
                sets = [(hashes[a:b], counts[a:b], weights[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                for x, y in zip(both[:part.num_rows], both[part.num_rows:]):
                    found.append(_jaccard(sets[place[x]], sets[place[y]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.float64()),
                 pa.array([x[1] for x in found], pa.float64())], ["left", "right", "weighted", "plain"])

    left = texts.select(F.col("node").alias("left"), F.col("text").alias("left_text"), F.col("seen").alias("left_seen"))
    right = texts.select(F.col("node").alias("right"), F.col("text").alias("right_text"), F.col("seen").alias("right_seen"))
    return pairs.join(right, "right").join(left, "left").select(
        "left", "right", "left_text", "right_text", "left_seen", "right_seen").mapInArrow(
        run, "left long, right long, weighted double, plain double")


def _crowd_links(texts: list[str], labels: np.ndarray, mine: np.ndarray, theirs: np.ndarray,
                 common: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Similar pairs (one of ``mine``, one of ``theirs``) of different labels, as places in ``texts``."""
    hashes, owners, counts = shingles_of(texts)
    return _similar(hashes, owners, counts, idf(hashes, common), labels, mine, theirs)


def _similar(hashes: np.ndarray, owners: np.ndarray, counts: np.ndarray, weights: np.ndarray, labels: np.ndarray,
             mine: np.ndarray, theirs: np.ndarray) -> list[tuple[int, int]]:
    """Similar pairs of different labels from the shingles of all texts with their weights.

    min(a, b) of two counts is the number of levels that both reach, so shared
    weights are matrix products over (shingle, level). What only one text has
    enters through its own sum. Pairs near the limit are computed exactly.
    """
    texts = len(labels)
    if not len(hashes):
        return []
    place = np.repeat(np.arange(len(hashes)), counts)
    level = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
    element = mix(hashes[place] + level.astype(np.uint64) * ODD[1]) if counts.max() > 1 else hashes
    owner, weight, single = owners[place], weights[place], level == 0
    distinct, column, met = np.unique(element, return_inverse=True, return_counts=True)
    sums = np.bincount(owner, weights=weight, minlength=texts)
    sizes = np.bincount(owner, weights=single, minlength=texts)
    shared_w = np.zeros((len(mine), len(theirs)))
    shared_p = np.zeros((len(mine), len(theirs)))
    columns = np.flatnonzero(met > 1)
    order = np.argsort(column, kind="stable")
    sorted_columns = column[order]
    for at in range(0, len(columns), 4096):
        some = columns[at:at + 4096]
        span = order[np.searchsorted(sorted_columns, some[0]):np.searchsorted(sorted_columns, some[-1], "right")]
        span = span[met[column[span]] > 1]
        dense = np.zeros((texts, len(some)), dtype=np.float32)
        root = np.zeros(len(some), dtype=np.float32)
        first = np.zeros(len(some), dtype=np.float32)
        to = np.searchsorted(some, column[span])
        dense[owner[span], to] = 1
        root[to], first[to] = weight[span], single[span]
        shared_w += (dense[mine] * root) @ dense[theirs].T
        shared_p += (dense[mine] * first) @ dense[theirs].T
    weighted = shared_w / np.maximum(sums[mine][:, None] + sums[theirs][None] - shared_w, 1e-9)
    plain = shared_p / np.maximum(sizes[mine][:, None] + sizes[theirs][None] - shared_p, 1e-9)
    near = (np.maximum(weighted, plain) >= SIMILARITY - 1e-3) & (labels[mine][:, None] != labels[theirs][None])
    edges = np.searchsorted(owners, np.arange(texts + 1))
    sets = lambda i: tuple(x[edges[i]:edges[i + 1]] for x in (hashes, counts, weights))
    return [(mine[i], theirs[j]) for i, j in zip(*np.nonzero(near))
            if max(_jaccard(sets(mine[i]), sets(theirs[j]))) >= SIMILARITY]


def _links_across(crowds: DataFrame, texts: DataFrame, shared=None, documents: int = 0) -> DataFrame:
    """Links (left, right) between members (node, label) of one crowd (hub) with different labels.

    Weights follow from the frequencies that ``texts`` (node, text, seen) carry, among so many
    ``documents``; without them (node, text) from a ``shared`` table as ``idf`` takes it.

    A crowd is cut into blocks of about ``BLOCK`` members, those of its most
    frequent label apart from the rest. Every pair of blocks is one group, so
    that no task holds more than two blocks; two blocks of the most frequent
    label never meet, as one label needs no link.
    """
    sizes = crowds.groupBy("hub", "label").agg(F.count("node").alias("n")).groupBy("hub").agg(
        F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"))
    sizes = stored(sizes.select(
        "hub", F.col("most.label").alias("main"), F.ceil(F.col("most.n") / BLOCK).cast("long").alias("main_blocks"),
        F.ceil((F.col("all") - F.col("most.n")) / BLOCK).cast("long").alias("rest_blocks")
    ).where("rest_blocks > 0"), "crowd-sizes")
    spread, main = F.xxhash64("node"), F.col("label") == F.col("main")
    dealt = crowds.join(sizes, "hub").select(
        "hub", "node", "label", F.when(main, F.pmod(spread, "main_blocks")).otherwise(
            F.col("main_blocks") + F.pmod(spread, "rest_blocks")).alias("block"),
        F.explode(F.sequence(F.when(main, F.col("main_blocks")).otherwise(F.lit(0).cast("long")),
                             F.col("main_blocks") + F.col("rest_blocks") - 1)).alias("other"))
    rows = dealt.join(texts, "node").select(
        "hub", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "label", "block", *texts.columns)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, low, high = key
        block = group["block"].to_numpy()
        hashes, owners, counts = shingles_of(group["text"].tolist())
        weights = (idf(hashes, shared.value) if shared else
                   weights_of(np.frombuffer(b"".join(group["seen"]), np.int32), documents))
        found = _similar(hashes, owners, counts, weights, group["label"].to_numpy(), np.flatnonzero(block == low),
                         np.flatnonzero(block == high))
        node = group["node"].to_numpy()
        pairs = {(min(node[i], node[j]), max(node[i], node[j])) for i, j in found}
        return pd.DataFrame(sorted(pairs), columns=["left", "right"], dtype="int64")

    return rows.groupBy("hub", "low", "high").applyInPandas(run, "left long, right long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (left, right) hangs together with.

    Every round takes the smallest label among neighbours and then jumps to the
    label's own label; it ends when a round changes nothing.
    """
    both = stored(edges.select("left", "right").union(edges.select("right", "left")).distinct(), "links")
    labels = stored(both.groupBy(F.col("left").alias("node")).agg(
        F.least(F.min("right"), F.first("left")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.right == labels.node).groupBy(F.col("left").alias("node")).agg(
            F.min("label").alias("near"))
        step = stored(labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("was")), "labels")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = stored(step.join(jump, "label").select(
            "node", F.least("label", "further").alias("label"), "was"), "labels")
        if not moved.where("label <> was").limit(1).count():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, text_id) for every row of ``docs`` (doc_id, text; other columns are not read).

    ``text_id`` is the smallest doc_id with an equal text, ``class_id`` the
    smallest of all documents linked to it. Two texts are linked if their TF-IDF
    weighted Jaccard similarity over five-word shingles is 0.8 or more (with the
    frequency of every shingle over all rows of ``docs``), or their plain one, so
    that a shingle's frequency within a large group of copies cannot part the
    group. Null texts are empty; texts without words are linked to equal ones
    only; fewer than five words make one shingle. Rows repeating a doc_id are one
    document; a null id is in the class of its text, or null. An empty table
    gives no rows.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.select("doc_id", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("key"), "text")
    documents, chars = rows.agg(F.count("text"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    signed = stored(_signed(rows, documents, chars), "signatures")
    classes = stored(signed.groupBy("key").agg(F.min("doc_id").alias("text_id")), "text-classes")
    kept = stored(signed.join(classes, (signed.key == classes.key) & (signed.doc_id == classes.text_id)).select(
        F.col("text_id").alias("node"), F.explode("bands").alias("band")).distinct(), "bands")

    sizes = stored(kept.groupBy("band").agg(F.count("node").alias("n")).where("n > 1"), "buckets")
    members = stored(kept.join(sizes, "band"), "members")
    mass = stored(members.groupBy("node").agg(F.sum("n").alias("mass")), "mass")
    seen = signed.join(mass, signed.doc_id == mass.node).groupBy("node", "key").agg(F.first("seen").alias("seen"))
    texts = stored(rows.join(seen, (rows.doc_id == seen.node) & (rows.key == seen.key)).groupBy("node").agg(
        F.min(F.struct("text", "seen")).alias("least")).select("node", "least.text", "least.seen"), "bucket-texts")

    hubs = stored(members.join(mass, "node").groupBy("band").agg(
        F.max(F.struct("mass", (-F.col("node")).alias("minus"))).alias("best")).select(
        "band", (-F.col("best.minus")).alias("hub")), "hubs")
    first = members.join(hubs, "band").where("node <> hub").select(
        F.least("hub", "node").alias("left"), F.greatest("hub", "node").alias("right")).distinct()
    tested = stored(_verify(stored(first, "pairs"), texts, documents), "tested")
    similar = f"weighted >= {SIMILARITY} OR plain >= {SIMILARITY}"
    links = tested.where(similar).select("left", "right")
    labels = components(links)

    # groups that share a bucket and are still apart: all members under the same hub meet, in blocks
    placed = stored(members.join(labels, "node", "left").select(
        "band", "node", F.coalesce("label", "node").alias("label")), "placed")
    apart = stored(placed.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").join(
        hubs, "band").select("band", "hub"), "apart")
    crowds = stored(placed.join(apart, "band").select("hub", "node", "label").distinct(), "crowds")
    more = stored(_links_across(crowds, texts, documents=documents), "links").distinct()
    if more.limit(1).count():
        labels = components(links.union(more))

    found = classes.join(labels, classes.text_id == labels.node, "left").select(
        "key", "text_id", F.coalesce("label", "text_id").alias("class_id"))
    return signed.select("doc_id", "key").join(stored(found, "classes"), "key").select(
        "doc_id", "class_id", "text_id")


def single_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every class the document with the smallest doc_id stays.

    Rows without a doc_id stay. Of rows that repeat a doc_id and a text one stays,
    the same in every run; another text under the same doc_id stays too.
    """
    kept = near_duplicates(docs).where("doc_id = class_id").select("doc_id").distinct()
    # the ids kept grow with the documents: one plan for every size
    kept = stored(kept, "kept").withColumnRenamed("doc_id", "_kept").hint("merge")
    one = docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi")
    repeated = docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").limit(1).count()
    if repeated:
        turn = Window.partitionBy("doc_id", "text").orderBy(F.xxhash64(*docs.columns))
        one = one.select(F.struct(*docs.columns).alias("_row"), F.row_number().over(turn).alias("_turn")).where(
            "_turn = 1").select("_row.*")
    return one.unionByName(docs.where(docs["doc_id"].isNull()))


@query("op9_neardup")
def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
