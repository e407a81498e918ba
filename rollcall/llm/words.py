"""Whole-text words and word n-grams as numpy arrays, a batch of documents at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once inside a task; a longer single text is one piece of its own.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.Table]:
    """The same rows in pieces of about SLICE_BYTES of text, so a task's memory is bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(size, dtype=np.int64) // SLICE_BYTES).astype(np.int64)
        starts = np.r_[np.flatnonzero(np.diff(piece, prepend=-1)), batch.num_rows]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            yield pa.Table.from_batches([batch.slice(lo, hi - lo)])


def split_words(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """(all words one after the other, number of words of each text).

    A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed
    and carriage return; a null or blank text has none.
    """
    plain = pc.ascii_trim_whitespace(pc.fill_null(texts, "")).combine_chunks()
    if isinstance(plain, pa.ChunkedArray):
        plain = pa.concat_arrays(plain.chunks) if plain.num_chunks else pa.array([], pa.string())
    blank = pc.equal(plain, "").to_numpy(zero_copy_only=False)
    parts = pc.ascii_split_whitespace(plain)
    flat, count = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    if blank.any():
        flat = flat.filter(pa.array(~np.repeat(blank, count)))
        count = np.where(blank, 0, count)
    return flat, count


#: One random 64-bit number for each (position in the word, byte): tabulation hashing.
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, (64, 256), np.uint64).ravel()


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of every word, the same in every task and on every machine."""
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], size)
    value = _TABLE[((place & 63) << 8) | data]
    if len(place) and place.max() >= 64:
        value = value * (2 * (place >> 6) + 1).astype(np.uint64)
    return mix(np.add.reduceat(value, offsets[:-1] - offsets[0]) + size.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def gram_hashes(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words of the flat array (runs may cross texts)."""
    size = len(word_hash) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ (out >> np.uint64(29))
        out += word_hash[i : i + size]
    return mix(out)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value in each window of ``width`` values."""
    size = len(values) - width + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    best, at, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:-step], best[step:]
        later = b < a
        best, at = np.where(later, b, a), np.where(later, at[step:], at[:-step])
        span += step
    return at
