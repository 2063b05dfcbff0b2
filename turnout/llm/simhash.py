"""SimHash near duplicates: exact pairs within a Hamming distance by vantage-point trees.

A fitted tree of vantage points and median distances deals every fingerprint to
one home shard. By the triangle inequality two fingerprints within ``LIMIT``
bits have distances to a vantage point that differ by ``LIMIT`` at most, so a
fingerprint is also sent, as a query, to the shards on the far side of every
boundary that is so close. Only those on the near side of a boundary cross it:
each pair meets once. Inside a shard the same splits go on down to small
leaves, where distances are counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnout.llm.common import stored, table, text_of
from turnout.llm.neardup import components
from turnout.llm.registry import query

WORDS = 3
SEED = 42
LIMIT = 3
#: Bytes of a text whose shingles are hashed at a time.
WINDOW = 1 << 20
#: Hashes that are counted at a time.
COUNTED = 1 << 18
LANES = np.uint64(0x0001000100010001)
#: Fingerprints of a shard, and sampled ones per shard to fit the tree on. With ``DEPTH`` the
#: sample has 2 million fingerprints (16 MB) at most; it is never more than 1/256 of them all
#: and 64 more.
SHARD = 8192
FITTED = 32
DEPTH = 16
#: Queries that meet a shard in one group.
QUERIES = 1 << 20
LEAF = 128
#: Linked pairs of a shard that are held before they are condensed.
PAIRS = 1 << 20
SPACE = re.compile(rb"[ \t-\r]")


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of all 3-word shingles of a text (UTF-8), repeats included, window by window."""
    held: list[bytes] = []
    begun, start = False, 0
    while start < len(text):
        gap = SPACE.search(text, start + WINDOW) if start + WINDOW < len(text) else None
        end = gap.start() if gap else len(text)
        words = held + text[start:end].lower().split()
        start = end
        if len(words) < WORDS:
            held = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        yield np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(
            starts[:1 - WORDS].tolist(), (ends[WORDS - 1:] - 1).tolist())), np.uint64, len(words) - WORDS + 1)
        begun, held = True, words[1 - WORDS:]
    if held and not begun:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, (segments, 64); segments begin at ``starts`` and hold under 2^16 hashes."""
    out = np.empty((len(starts), 64), np.int64)
    for k in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & LANES, starts)
        for j in range(4):
            out[:, k + 16 * j] = (sums >> np.uint64(16 * j)) & np.uint64(0xFFFF)
    return out


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The 64-bit fingerprint of every text; a bit is set if over half of the shingles have it."""
    ones, n = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    parts: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def count() -> None:
        if not parts:
            return
        pieces = [(o, p[a:a + 2**15]) for o, p in zip(owners, parts) for a in range(0, len(p), 2**15)]
        sizes = np.array([len(p) for _, p in pieces])
        owner = np.array([o for o, _ in pieces])
        np.add.at(ones, owner, bit_counts(np.concatenate(parts), np.cumsum(sizes) - sizes))
        np.add.at(n, owner, sizes)
        parts.clear()
        owners.clear()

    for at, text in enumerate(texts):
        for hashes in shingle_hashes(text):
            parts.append(hashes)
            owners.append(at)
            held += len(hashes)
            if held >= COUNTED:
                count()
                held = 0
    count()
    return ((2 * ones > n[:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def distances(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point).astype(np.int64)


def vantage(values: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """A point of ``values`` whose distances spread widely, and a distance that parts them near the middle.

    Of two or more distinct values at least one lies on each side.
    """
    tried = rng.choice(values, min(8, len(values)), replace=False)
    seen = rng.choice(values, min(256, len(values)), replace=False)
    point = max(tried, key=lambda p: float(distances(seen, p).std()))
    found = distances(values, point)
    return point, int(min(np.median(found), found.max() - 1))


class Router:
    """The upper levels of the tree, as a full binary tree of ``depth`` levels in heap order."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.point = np.zeros((1 << depth) - 1, np.uint64)
        self.radius = np.full((1 << depth) - 1, 64, np.int64)
        rng = np.random.default_rng(1)
        held = {0: sample}
        for node in range(len(self.point)):
            values = held.pop(node, sample[:0])
            if len(values) > 1:
                self.point[node], self.radius[node] = vantage(values, rng)
            near = distances(values, self.point[node]) <= self.radius[node]
            held[2 * node + 1], held[2 * node + 2] = values[near], values[~near]

    def route(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``values``, shard, is a query) of every visit: one home each, and the queries."""
        place, node = np.arange(len(values)), np.zeros(len(values), np.int64)
        asks = np.zeros(len(values), bool)
        for _ in range(self.depth):
            far, radius = distances(values[place], self.point[node]), self.radius[node]
            left = np.where(asks, far <= radius + LIMIT, far <= radius)
            right = np.where(asks, far > radius - LIMIT, far > radius)
            over = ~asks & left & (far > radius - LIMIT)
            place = np.concatenate([place[left], place[right], place[over]])
            node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2, 2 * node[over] + 2])
            asks = np.concatenate([asks[left], asks[right], np.ones(int(over.sum()), bool)])
        return place, node - len(self.point), asks


def forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each of ``n`` nodes to the smallest one it hangs together with."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    own = np.flatnonzero(label != np.arange(n))
    return label[own], own


def near_links(values: np.ndarray, homes: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold together what is within ``LIMIT`` bits: homes among themselves, and queries with homes.

    The first ``homes`` of ``values`` are at home here, the others queries.
    Returns a spanning forest of these pairs, as places in ``values``.
    """
    rng = np.random.default_rng(2)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    stack = [(np.arange(homes), np.arange(homes, len(values)))]
    while stack:
        home, asks = stack.pop()
        if len(home) <= LEAF:
            for at in range(0, len(asks) + len(home), 4096):
                some = np.concatenate([home, asks])[at:at + 4096]
                i, j = np.nonzero(np.bitwise_count(values[some][:, None] ^ values[home][None]) <= LIMIT)
                new = some[i] != home[j]
                found.append((some[i][new], home[j][new]))
                held += int(new.sum())
            if held > PAIRS:
                found = [forest(len(values), *map(np.concatenate, zip(*found)))]
                held = len(found[0][0])
            continue
        point, radius = vantage(values[home], rng)
        far, asked = distances(values[home], point), distances(values[asks], point)
        near = far <= radius
        # tight shells around the point, by the homes on each side
        first, last = int(far[~near].min()), int(far[near].max())
        low, high = int(far[near].min()), int(far.max())
        stack.append((home[near], asks[(asked <= last + LIMIT) & (asked >= low - LIMIT)]))
        stack.append((home[~near], np.concatenate([
            asks[(asked >= first - LIMIT) & (asked <= high + LIMIT)], home[near & (far >= first - LIMIT)]])))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(len(values), *map(np.concatenate, zip(*found)))


def signed_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as long) for every row of ``docs`` (doc_id, text)."""
    names = ["doc_id", "fingerprint"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(
                    fingerprints(part.column(1).to_pylist()).view(np.int64))], names)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, fingerprint long")


def near_fingerprints(prints: DataFrame) -> DataFrame:
    """Links (left, right) that hold together all ``fingerprint`` values (distinct) within ``LIMIT`` bits.

    The tree is fitted on a sample of bounded size; every fingerprint is at
    home in one shard and a query in all shards it may have partners in. A
    shard's queries are split into groups of about ``QUERIES``, each with all
    the shard's homes.
    """
    spark = prints.sparkSession
    total = prints.count()
    depth = min(DEPTH, max(0, (total - 1) // SHARD).bit_length())
    every = max(1, total // (FITTED << depth))
    sample = prints.where(F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.lit(every)) == 0) if depth else prints.limit(0)
    router = spark.sparkContext.broadcast(Router(np.sort(np.array(
        [r[0] for r in sample.toLocalIterator()], np.int64)).view(np.uint64), depth))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << depth, np.int64)
        for batch in batches:
            _, shard, asks = router.value.route(batch.column(0).to_numpy().view(np.uint64))
            sums += np.bincount(shard[asks], minlength=len(sums))
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"shard": used, "n": sums[used]})

    groups = np.ones(1 << depth, np.int64)
    for shard, n in prints.mapInArrow(count, "shard long, n long").groupBy("shard").agg(F.sum("n")).collect():
        groups[shard] = -(-n // QUERIES)
    split = spark.sparkContext.broadcast(groups)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                values = batch.column(0).slice(at, 1024).to_numpy()
                place, shard, asks = router.value.route(values.view(np.uint64))
                blocks = split.value[shard]
                times = np.where(asks, 1, blocks)
                turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                place, shard, asks, blocks = (np.repeat(x, times) for x in (place, shard, asks, blocks))
                yield pa.RecordBatch.from_pydict({
                    "shard": shard, "part": np.where(asks, values.view(np.uint64)[place] % blocks.astype(np.uint64),
                                                     turn.astype(np.uint64)).astype(np.int64),
                    "fingerprint": values[place], "asks": asks})

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["asks", "fingerprint"])
        values = group["fingerprint"].to_numpy()
        left, right = near_links(values.view(np.uint64), int((~group["asks"]).sum()))
        return pd.DataFrame({"left": values[left], "right": values[right]})

    return prints.mapInArrow(deal, "shard long, part long, fingerprint long, asks boolean").groupBy(
        "shard", "part").applyInPandas(link, "left long, right long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text; other columns are not read).

    Texts are lower-cased (A-Z); words end at blanks and control characters 9
    to 13; a shingle is three words, or all words of a shorter text. Null texts
    are empty; a text without words has the fingerprint zero, which links like
    any other. ``component_id`` is the smallest doc_id among all documents that
    links of up to ``LIMIT`` differing bits connect. Rows that repeat a doc_id
    are documents of their own; rows with a null id link others and get the
    component's smallest id, null if it has none. An empty table gives no rows.
    """
    signed = stored(signed_documents(docs), "fingerprints")
    prints = stored(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "prints")
    links = stored(near_fingerprints(prints.select("fingerprint")), "near-prints")
    found = prints.withColumnRenamed("first", "component_id")
    if links.limit(1).count():
        labels = components(links)
        joined = stored(prints.join(labels, prints.fingerprint == labels.node), "linked-prints")
        least = joined.groupBy("label").agg(F.min("first").alias("least"))
        linked = joined.select("fingerprint", "label").join(stored(least, "components"), "label")
        found = prints.join(linked.select("fingerprint", "least", F.lit(True).alias("in_links")), "fingerprint", "left").select(
            "fingerprint", F.when(F.col("in_links"), F.col("least")).otherwise(F.col("first")).alias("component_id"))
    return signed.join(stored(found, "print-components"), "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query("op11_simhash")
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_components(table(spark, sf_dir, "documents"))
