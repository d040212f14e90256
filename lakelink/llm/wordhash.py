"""Words of whole Arrow text columns as numpy arrays: no Python object is made for a word.

A word is a run of bytes outside 0x20 and 0x09-0x0D, A-Z lower-cased. Its 64-bit hash is a polynomial over its bytes,
taken from one running sum per slice and then mixed, so equal words have equal hashes in every process.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SLICE_BYTES = 1 << 21


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, for i below n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, BASE_INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def span_hash(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of units[starts[i]:ends[i]]."""
    up, down = powers(len(units) + 1)
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words(NamedTuple):
    """first: index of the slice's first row; docs: rows in it; doc: row of each word, from 0."""

    first: int
    docs: int
    doc: np.ndarray
    hash: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    units: np.ndarray
    offsets: np.ndarray


def slices(text: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) of runs of rows with about `most` bytes; nulls count as empty."""
    text = pc.fill_null(text, "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    wide = pa.types.is_large_string(text.type)
    _, at, data = text.buffers()
    off = np.frombuffer(at, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64) if len(text) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, off[i : j + 1] - off[i], raw[off[i] : off[j]]
        i = j


def lowered(raw: np.ndarray) -> np.ndarray:
    return raw + (((raw >= 65) & (raw <= 90)) * np.uint8(32)).astype(np.uint8)


def words(text: pa.Array, most: int = SLICE_BYTES) -> Iterator[Words]:
    for first, off, raw in slices(text, most):
        units = lowered(raw)
        n = len(units)
        solid = np.zeros(n + 2, bool)
        solid[1:-1] = ~((units == 32) | ((units >= 9) & (units <= 13)))
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
        ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
        doc = np.searchsorted(off, starts, "right") - 1
        yield Words(first, len(off) - 1, doc, span_hash(units, starts, ends), starts, ends, units, off)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of `size` words in each row, sorted by row then hash.

    A row with fewer words, but at least one, has its whole sequence as one shingle.
    """
    n = len(w.hash)
    per = np.bincount(w.doc, minlength=w.docs)
    first = np.concatenate([[0], np.cumsum(per)[:-1]])
    keep = np.zeros(n, bool)
    if n >= size:
        keep[: n - size + 1] = w.doc[: n - size + 1] == w.doc[size - 1 :]
    at = np.flatnonzero(keep)
    acc = np.full(len(at), size, np.uint64)
    for j in range(size):
        acc = mix(acc * BASE + w.hash[at + j])
    doc = w.doc[at]
    short = np.flatnonzero((per > 0) & (per < size))
    if len(short):
        tail = per[short].astype(np.uint64)
        for j in range(size - 1):
            more = per[short] > j
            tail[more] = mix(tail[more] * BASE + w.hash[first[short[more]] + j])
        acc, doc = np.concatenate([acc, tail]), np.concatenate([doc, short])
    order = np.lexsort((acc, doc))
    acc, doc = acc[order], doc[order]
    new = np.ones(len(acc), bool)
    new[1:] = (acc[1:] != acc[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], acc[new]


def trim() -> None:
    """Give memory that is free back to the system: a Python worker goes on to other stages, whose steps need it elsewhere."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: What a worker keeps from task to task, by the number of the broadcast object it is made of (and holds), until a task without that broadcast comes.
held: dict = {}


def make_way(shared: tuple = ()) -> None:
    if held and not any(id(b) in held for b in shared):
        held.clear()
        trim()


def tidy(run, *shared):
    """run, for mapInArrow, with trim() at the end; a worker keeps no copy of the broadcasts `shared`, but reads them again in its next task."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_way(shared)
        yield from run(batches)
        for b in shared:
            b.__dict__.pop("_value", None)
        trim()

    return tidied


def tidy_group(run):
    """run, for applyInArrow on groups, with trim() after each."""

    def tidied(keys, table):
        make_way()
        out = run(keys, table)
        del table
        trim()
        return out

    return tidied
