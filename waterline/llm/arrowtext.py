"""Text columns as numpy arrays inside Spark tasks: UTF-8 bytes, words, word hashes, shingles.

Everything here works on one Arrow batch at a time, over whole texts, without per-word Python objects.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts of about this many bytes are worked on together; one longer text is worked on alone.
SLICE_BYTES = 1 << 19
WIDTH = 5

_random = np.random.default_rng(20240607)
_BYTE_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_JOIN = np.uint64(0xD6E8FEB86659FD93)

#: Bytes that separate words: space and tab to carriage return.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that separate words when punctuation is dropped as well; bytes of other scripts belong to words.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``text``, at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; a null text has no bytes."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the index of its first word (one more at the end)."""
    inside = ~blank[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, blank: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    code = np.where(blank, np.uint64(0), _BYTE_CODE)
    lengths = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _STEP, dtype=np.uint64))
    terms = code[data[starts[0] :]] * powers[place]
    return mixed(np.add.reduceat(terms, starts - starts[0]))


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words of a row, and each row's first run (one more at the end).

    A row with fewer words has its whole sequence as one run; a row without words has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(runs)])
    begin = np.repeat(first[:-1] - at[:-1], runs) + np.arange(at[-1])
    size = np.repeat(np.minimum(counts, width), runs)
    h = size.astype(np.uint64)
    for k in range(width):
        part = hashes[np.minimum(begin + k, max(len(hashes) - 1, 0))] if len(hashes) else h
        h = np.where(k < size, mixed(h * _JOIN + part), h)
    return h, at


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows that share a key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        change = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column(key)[0] != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)
