"""Words, word hashes and shingles of Arrow text columns, computed with numpy on whole byte buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D, after lower-casing A-Z; it never crosses documents.
Null texts have no bytes. Buffers are cut between documents into pieces of about ``PIECE`` bytes, so memory follows
the piece (or one very long document), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 3 << 20
SHINGLE = 5

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64. Made anew for every piece: workers keep nothing between tasks."""
    made = []
    for step in (_BASE, _INVERSE):
        factors = np.full(n, step, np.uint64)
        factors[0] = 1
        made.append(np.cumprod(factors))
    return made[0], made[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Piece:
    """Documents ``first`` to ``last`` (exclusive) of a batch: their bytes, and the hash and place of each word."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray  # byte offsets of the documents, one more than documents
    hashes: np.ndarray  # one per word
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray  # word offsets of the documents, one more than documents


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    width = np.int64 if wide else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def cuts(bounds: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``size`` bytes."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def pieces(column: pa.Array | pa.ChunkedArray, size: int = PIECE) -> Iterator[Piece]:
    data, bounds = buffers(column)
    for first, last in cuts(bounds, size):
        part = data[bounds[first] : bounds[last]]
        at = bounds[first : last + 1] - bounds[first]
        yield Piece(first, last, part, at, *words(part, at))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and the word offsets of the documents."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(bounds), np.int64)
    solid = ~_IS_SPACE[data]
    before = np.empty(n, bool)  # whether the byte before belongs to the same run
    before[0] = False
    before[1:] = solid[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    power, inverse = _tables(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_LOWER[data] * power[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words, and the offsets of the documents.

    A document with fewer words has its whole sequence as the only one; one without words has none.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=out[1:])
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    n = len(hashes)
    full = np.zeros(max(n, 1), np.uint64)
    if n >= size:
        top = n - size + 1
        run = hashes[:top].copy()
        for k in range(1, size):
            run *= _STEP
            run += hashes[k : k + top]
        full[:top] = run
    # the place of each shingle's first word
    first = np.repeat(offsets[:-1] - out[:-1], made) + np.arange(out[-1])
    values = full[first]
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        run = np.full(1, counts[d], np.uint64)
        for k in range(offsets[d], offsets[d + 1]):
            run = run * _STEP + hashes[k : k + 1]
        values[out[d]] = run[0] ^ _STEP
    return mix(values), out


def sql_sets(table: str, key: str) -> str:
    """The same shingles as SQL: rows of ``key`` and shingle, distinct."""
    return rf"""
  select distinct {key}, unnest(case when len(ws) >= 5
      then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      when len(ws) > 0 then [len(ws) || ' words: ' || array_to_string(ws, ' ')] else [] end) as shingle
  from (
    select {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') as ws from {table}
  )"""
