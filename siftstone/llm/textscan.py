"""Words of whole Arrow text columns as numpy arrays: no Python object is made for a word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240607)
BYTE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(count: int) -> np.ndarray:
    out = np.full(count, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


@dataclass
class Words:
    """Words of rows first to last of a batch. low: their lower-cased bytes; starts, ends: in low; first_word: of each row, and the end."""

    first: int
    last: int
    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first_word: np.ndarray


def scan(column: pa.Array, inside: np.ndarray, chunk: int = 1 << 20, most_rows: int = 1 << 16) -> Iterator[Words]:
    """Words (maximal runs of bytes marked in inside, after lower-casing A-Z) of runs of at most most_rows rows of about chunk bytes, in order.

    A longer text is one run; its bytes are hashed in steps of chunk, so memory beyond its words stays bounded.
    """
    data, offsets = buffers(column)
    first = 0
    while first < len(column):
        last = max(first + 1, min(first + most_rows, int(np.searchsorted(offsets, offsets[first] + chunk, "right")) - 1))
        low = LOWER[data[offsets[first] : offsets[last]]]
        at = offsets[first : last + 1] - offsets[first]
        word = inside[low]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        heads = at[:-1][at[:-1] < len(low)]
        begins[heads] = word[heads]
        stops = word.copy()
        stops[:-1] &= ~word[1:]
        tails = at[1:][at[1:] > 0] - 1
        stops[tails] = word[tails]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        yield Words(first, last, low, starts, ends, word_hashes(low, starts, ends, chunk), np.searchsorted(starts, at))
        first = last


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int) -> np.ndarray:
    """64-bit polynomial hash of each word, over its bytes and length."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    table = powers(int((ends - starts).max()))
    k = 0
    while k < len(starts):
        m = max(k + 1, int(np.searchsorted(ends, starts[k] + chunk, "right")))
        lengths = ends[k:m] - starts[k:m]
        edges = np.concatenate(([0], np.cumsum(lengths)))
        place = np.arange(edges[-1]) - np.repeat(edges[:-1], lengths)
        letters = low[place + np.repeat(starts[k:m], lengths)]
        out[k:m] = np.add.reduceat(BYTE[letters] * table[place], edges[:-1])
        k = m
    return mix(out + (ends - starts).astype(np.uint64))
