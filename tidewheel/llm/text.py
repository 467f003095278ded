"""Words, word hashes and shingles of a block of texts, as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Everything works on blocks of a few
megabytes, so a task holds one block at a time however large its partition is.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21
SMALL_BLOCK = 1 << 19  # for operators whose arrays take some fifty bytes a byte of text
SHINGLE = 5
KEPT: dict[tuple, object] = {}  # what a worker process keeps from task to task: vocabularies

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))[_LOWER]
_BASE = 0x9E3779B97F4A7C17  # 3 modulo 4, so that swapped letters keep nearly all bits apart
_SLOT = mix(np.arange(1, 65, dtype=_U) * _U(0xD1B54A32D192ED03)) | _U(1)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n + (n >> 3), SMALL_BLOCK + (1 << 16)), base, _U)
        have[0] = 1
        _powers[name] = have = np.multiply.accumulate(have)
    return have


class Block(NamedTuple):
    """Texts end to end as bytes; document d is data[offsets[d]:offsets[d + 1]], each with a separator as last byte."""
    data: np.ndarray
    offsets: np.ndarray


def release() -> None:
    """Give back what tasks of other operators have left in this worker process."""
    if KEPT:
        KEPT.clear()
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # not glibc


def joined(texts: pa.Array, before: bytes = b"", after: bytes = b"\n") -> Block:
    kind = pa.large_binary()
    filled = pc.fill_null(texts.cast(kind), pa.scalar(b"", kind))
    whole = pc.binary_join_element_wise(pa.scalar(before, kind), filled, pa.scalar(after, kind), pa.scalar(b"", kind))
    if not len(whole):
        return Block(np.empty(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    return Block(np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0])


class Words(NamedTuple):
    """`hashes` of all words of a block in order; document d has those from `first[d]` to `first[d + 1]`."""
    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def words(texts: pa.Array) -> Words:
    """All words of a block of texts; a null text has none. Offsets are bytes from the start of the document."""
    data, offsets = joined(texts)
    if not len(data):
        return Words(np.empty(0, _U), np.zeros(len(offsets), np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]  # the last byte is a separator, so every word ends
    n = len(data)
    total = np.empty(n + 1, _U)
    total[0] = 0
    np.cumsum(_BYTE[data] * _power("up", _BASE, n + 1)[:n], out=total[1:])
    inverse = _power("down", pow(_BASE, -1, 1 << 64), n + 1)
    hashes = mix((total[end] - total[start]) * inverse[start])
    first = np.searchsorted(start, offsets).astype(np.int64)
    shift = np.repeat(offsets[:-1], np.diff(first))
    return Words(hashes, first, start - shift, end - shift)


def shingles(block: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words of each document in order, and where each document's begin.

    A document with fewer words has its whole sequence as its only one, a document without words has none.
    """
    if not 1 <= size <= 32:
        raise ValueError("shingles have 1 to 32 words")
    counts = np.diff(block.first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(first[-1], _U)
    n = len(block.hashes)
    if n >= size:
        every = np.zeros(n - size + 1, _U)
        for j in range(size):
            every += block.hashes[j:n - size + 1 + j] * _SLOT[j]
        where = np.arange(first[-1]) + np.repeat(block.first[:-1] - first[:-1], runs)
        np.take(every, np.minimum(where, n - size), out=out)
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        own = block.hashes[block.first[d]:block.first[d + 1]]
        out[first[d]] = np.append(own * _SLOT[:len(own)], _SLOT[32 + len(own)]).sum()
    return mix(out), first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of every segment in ascending order, and where each segment begins. Changes `values`."""
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        values[a:b].sort()
    if not len(values):
        return values, first
    new = np.empty(len(values), bool)
    new[0] = True
    np.not_equal(values[1:], values[:-1], out=new[1:])
    starts = first[:-1][np.diff(first) > 0]
    new[starts] = True
    seen = np.concatenate([[0], np.cumsum(new)])
    return values[new], seen[first]


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of every segment, modulo 2^64 for unsigned numbers."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[first[1:]] - total[first[:-1]]
