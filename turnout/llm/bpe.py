"""Byte-level BPE encoding and decoding with forced boundaries.

Two neighbouring bytes that occur side by side in no token of the vocabulary
can never end up in one token, so a cut between them is certain. Words are cut
at all such places, the fragments are encoded on their own, and their ids are
put together again. The table of joinable byte pairs follows from the
vocabulary file alone.

Words short enough to be remembered are not merged: their tokens are the one
row of tokens in which every two neighbours, encoded on their own, stay these
two. So a word is a first token and the row of the rest, if the two that meet
there stay; rests recur and are remembered, and so is whether two tokens stay.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from turnout.llm.common import table
from turnout.llm.registry import query

#: Fixed value: how byte-level BPE vocabularies of this kind split text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words, and rests of words, remembered by one worker; the memory starts anew beyond that, results do not change. Workers
#: outlive their tasks, so this memory (about 420 bytes a word) stays beside whatever runs next.
REMEMBERED = 200_000
#: Longer words are not remembered.
LONGEST = 64
#: Pairs of tokens remembered by one worker, as neighbours or not.
PAIRS = 500_000
#: Fragments up to this length are merged by plain search.
SHORT = 24
NEVER = (1 << 30, -1)
NONE = [NEVER] * SHORT
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, letter to byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Known(dict):
    """Ids of words seen before; a new word is encoded when it is asked for."""

    def __init__(self, coder: Codec):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> tuple[int, ...]:
        raw, coder = word.encode(), self.coder
        ids = coder.tails.row(raw) if coder.complete and len(raw) <= LONGEST else tuple(coder.merged(raw))
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class Neighbours(dict):
    """Whether two tokens, given as their ids, stay these two if they are encoded together."""

    def __init__(self, coder: Codec):
        super().__init__()
        self.coder = coder

    def __missing__(self, pair: tuple[int, int]) -> bool:
        left, right = pair
        if len(self) >= PAIRS:
            self.clear()
        stay = self[pair] = self.coder.merged(self.coder.bytes_of[left] + self.coder.bytes_of[right]) == [left, right]
        return stay


class Tails(dict):
    """Ids of rests of short words seen before."""

    def __init__(self, coder: Codec):
        super().__init__()
        self.whole, self.longest, self.neighbours = coder.whole, coder.longest, Neighbours(coder)

    def __missing__(self, raw: bytes) -> tuple[int, ...]:
        ids = self.row(raw)
        if len(self) >= REMEMBERED:
            self.clear()
        self[raw] = ids
        return ids

    def row(self, raw: bytes) -> tuple[int, ...]:
        """The row of tokens of a short word; longer first tokens are tried first."""
        for end in range(min(len(raw), self.longest[raw[0]]), 0, -1):
            first = self.whole.get(raw[:end])
            if first is not None:
                if end == len(raw):
                    return (first,)
                rest = self[raw[end:]]
                if self.neighbours[first, rest[0]]:
                    return (first, *rest)
        raise AssertionError(f"no row of tokens for {raw!r}")


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, content: str):
        data = json.loads(content)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.bytes_of = {i: raw(token) for token, i in data["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.id_of = {raw(token): i for token, i in data["model"]["vocab"].items()}
        self.byte_ids = [self.id_of.get(bytes([b])) for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges[self.id_of[left], self.id_of[right]] = (rank, self.id_of[left + right])
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.joinable = {pair for token in self.id_of for pair in zip(token, token[1:])}
        self.words = regex.compile(WORDS)
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.known = Known(self)
        # tokens that merging arrives at, and how long they get by first byte
        self.whole = {token: i for token, i in self.id_of.items() if self.merged(token) == [i]}
        self.longest = [0] * 256
        for token in self.whole:
            self.longest[token[0]] = max(self.longest[token[0]], len(token))
        self.complete = None not in self.byte_ids
        self.tails = Tails(self)

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word by merging its fragments."""
        return list(chain.from_iterable(map(self.merge, self.fragments(word))))

    def fragments(self, word: bytes) -> list[bytes]:
        """``word`` cut wherever two neighbouring bytes are not joinable."""
        cuts = [at for at, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.joinable]
        if not cuts:
            return [word] if word else []
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: lowest rank first, leftmost among equals."""
        if len(fragment) > SHORT:
            return self._merge_long(fragment)
        ids = [self.byte_ids[b] for b in fragment]
        found = list(map(self.merges.get, zip(ids, ids[1:]), NONE))
        while found:
            best = min(found)
            if best is NEVER:
                break
            at = found.index(best)
            ids[at:at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = self.merges.get((ids[at - 1], best[1]), NEVER)
            if at < len(found):
                found[at] = self.merges.get((best[1], ids[at + 1]), NEVER)
        return ids

    def _merge_long(self, fragment: bytes) -> list[int]:
        """As ``merge``, by a heap over linked parts, so that time stays near the length."""
        ids: list[int | None] = [self.byte_ids[b] for b in fragment]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, joined = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = joined, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    found = merges.get((ids[a], ids[b]))
                    if found:
                        heapq.heappush(queue, (found[0], a, ids[a], ids[b], found[1]))
        return [i for i in ids if i is not None]

    def encode(self, text: str) -> list[int]:
        pieces = self.split.split(text) if self.split else [text]
        out: list[int] = []
        for piece in pieces:
            if piece in self.special:
                out.append(self.special[piece])
            else:
                out += chain.from_iterable(map(self.known.__getitem__, self.words.findall(piece)))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def codec(content: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(content)


def vocabulary(spark: SparkSession, path: str) -> str:
    """The vocabulary file's text, read through Spark, or from the driver's disk for a bare path."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            return f.read()
    return spark.read.text(path, wholetext=True).first()["value"]


def _per_text(docs: DataFrame, content: str, schema: str, types: list[pa.DataType],
              row: Callable[[Codec, str], tuple]) -> DataFrame:
    """doc_id and what ``row`` gives for every text; the file travels as one broadcast (1.6 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [row(coder, text or "") for text in part.column(1).to_pylist()]
                columns = [part.column(0), *(pa.array(c, kind) for c, kind in zip(zip(*rows), types))]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [field.split(" ")[0] for field in schema.split(", ")]
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, schema)


def encode_documents(docs: DataFrame, content: str) -> DataFrame:
    """doc_id and ``ids`` for every row; null texts are empty and give no ids.

    Rows are independent, so repeated ones give equal results, null doc_ids
    stay null and an empty table gives no rows. Only doc_id and text are read.
    """
    return _per_text(docs, content, "doc_id long, ids array<int>", [pa.list_(pa.int32())], lambda c, t: (c.encode(t),))


def encode_digest(docs: DataFrame, content: str) -> DataFrame:
    """Number of tokens, digest of the ids and digest of the text decoded from them, per row."""
    def row(coder: Codec, text: str) -> tuple[int, str, str]:
        ids = coder.encode(text)
        listed = ",".join(map(coder.text_of.__getitem__, ids)).encode()
        decoded = coder.decode(ids).encode("utf-8", errors="replace")
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest()
    return _per_text(docs, content, DIGEST, [pa.int64(), pa.string(), pa.string()], row)


def default_vocabulary(spark: SparkSession) -> str:
    import public_tokenizers
    return vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: tokens and digests of every document."""
    return encode_digest(docs, default_vocabulary(spark))


@query("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded."""
    return encode_digest(table(spark, sf_dir, "documents"), default_vocabulary(spark))
