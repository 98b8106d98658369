"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# Text bytes worked on at once; each takes some 30 bytes of arrays meanwhile.
PIECE_BYTES = 4 << 20


def release() -> None:
    """Give memory that is free back to the system: workers stay for the next stage, and what
    they keep adds up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def solid_bytes(data: np.ndarray) -> np.ndarray:
    """False for white space: the space and the control characters 9 to 13."""
    return (data != 32) & ((data - np.uint8(9)) > 4)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z."""
    return data + np.uint8(32) * ((data - np.uint8(65)) < 26)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all others (splitmix64)."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, U64) + U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def join_hashes(*columns: np.ndarray) -> np.ndarray:
    """One hash for each row of hashes; the order of the columns matters."""
    out = columns[0]
    with np.errstate(over="ignore"):
        for column in columns[1:]:
            out = mix(out * U64(3) + column)
    return out


def plain(texts: pa.Array) -> pa.Array:
    """As an array of strings without nulls; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.string()), "")


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``limit`` bytes, with the place of their first text; a longer text
    is a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends; no word reaches from one text into the next."""
    solid = solid_bytes(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], solid[:-1]))[: len(solid)]
    after = np.concatenate((solid[1:], [False]))[: len(solid)]
    starts = np.flatnonzero(solid & (edge[:-1] | ~before))
    return starts, np.flatnonzero(solid & (edge[1:] | ~after)) + 1


def words_per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(starts, offsets))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes of each span, eight bytes at a time."""
    sizes = ends - starts
    out = np.full(len(starts), seed, U64)
    padded = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(8, np.uint8))), 8)
    live, begin, left = np.arange(len(starts)), starts, sizes
    while len(live):
        words = np.ascontiguousarray(padded[begin]).view("<u8").ravel()
        cut = (8 * (8 - np.minimum(left, 8))).astype(U64)
        words = np.where(left > 0, (words << cut) >> cut, U64(0))
        with np.errstate(over="ignore"):
            out[live] = mix(out[live] * U64(3) + words)
        more = left > 8
        live, begin, left = live[more], begin[more] + 8, left[more] - 8
    with np.errstate(over="ignore"):
        return mix(out + sizes.astype(U64))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of a piece of texts, and the words of each text."""
    data, offsets = raw_bytes(texts)
    starts, ends = word_spans(data, offsets)
    return hash_spans(lowered(data), starts, ends), words_per_text(starts, offsets)


def hash_word(word: str) -> int:
    """The hash of one word, as ``hashed_words`` has it."""
    return int(hashed_words(pa.array([word]))[0][0])


def runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values of a sorted array begins."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
