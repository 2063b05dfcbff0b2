"""Vectorised words of many texts: hashes and owners, for work inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
CHUNK = 1 << 20

#: True for ASCII bytes that end a word; letters, digits and all bytes of other characters do not.
SEPARATES = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def rising(base: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return rising(BASE), rising(pow(BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that every bit counts."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, owner) of every lower-cased word, in order; owner is the text's index."""
    coded = [t.lower().encode("utf-8", "replace") for t in texts]
    buffer = np.frombuffer(b" ".join(coded) + b" ", dtype=np.uint8)
    gap = SEPARATES[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    size = 1 << max(16, int(len(buffer) + 1).bit_length())
    power, inverse = _powers(size)
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[:len(buffer)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    offsets = np.cumsum([0, *(len(c) + 1 for c in coded)])
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def chunks(texts: list[str], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` characters each; a longer text is alone."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text) > size:
            yield start, at
            start, held = at, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def text_parts(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts, nulls as empty ones, of bounded size."""
    place = batch.schema.get_field_index(column)
    for at in range(0, batch.num_rows, 1024):
        part = batch.slice(at, 1024)
        texts = [t or "" for t in part.column(place).to_pylist()]
        for start, end in chunks(texts):
            yield part.slice(start, end - start), texts[start:end]
