"""Arrow batches of texts as coded words, so that Python work is per distinct word or vectorised."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``most`` bytes of text each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + most, "right")))
            yield batch.slice(at, end - at)
            at = end
    pa.default_memory_pool().release_unused()  # workers live on after their task


@dataclass
class Words:
    """Text i has the words ``codes[starts[i]:starts[i + 1]]``, numbers into ``vocabulary``."""

    codes: np.ndarray
    starts: np.ndarray
    vocabulary: list[str]


_LOWER = {c: c + 32 for c in range(65, 91)}


def coded(texts: pa.Array, lower: bool = False) -> Words:
    """Words as runs of anything but ASCII white space; ``lower`` maps A-Z only.  Null: no words.

    With ``lower`` the vocabulary may hold a word twice.
    """
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy().astype(np.int64)
    flat = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, vocabulary = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.to_pylist()
    keep = np.ones(len(codes), bool)
    if "" in vocabulary:
        keep = codes != vocabulary.index("")
    if lower:
        vocabulary = [w.lower() if w.isascii() else w.translate(_LOWER) for w in vocabulary]
    starts = np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]]
    return Words(codes[keep].astype(np.int64), starts, vocabulary)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of the runs [starts[i], starts[i] + lengths[i]), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def word_hashes(vocabulary: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))


def _lowered(texts: pa.Array) -> pa.Array:
    """A-Z as a-z, byte by byte: no byte of a longer character is a letter."""
    _, offsets, data = texts.buffers()
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(raw)], 0, texts.offset)


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased (A-Z) words, and where each text's begin (one more at the end); texts are not null.

    A word's hash is the sum of a number for each of its bytes and places.  Work is per
    distinct word and without Python strings.
    """
    split = pc.ascii_split_whitespace(_lowered(texts.cast(pa.large_string())))
    offsets = split.offsets.to_numpy().astype(np.int64)
    flat = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, words = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    sizes = np.diff(ends)
    place = np.arange(len(raw)) - np.repeat(ends[:-1] - ends[0], sizes)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(raw.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8))))])
    bounds = ends - ends[0]
    hashes = mix(upto[bounds[1:]] - upto[bounds[:-1]] + sizes.astype(np.uint64))
    keep = sizes[codes] > 0 if len(codes) else np.zeros(0, bool)
    starts = np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]]
    return hashes[codes[keep]] if len(codes) else np.zeros(0, np.uint64), starts


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of ``n`` neighbours in ``hashes``; the order counts."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(out)] + np.uint64(i + 1))
    return out


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Like :func:`chained`, for long windows: a window is made of two halves, so the work grows with the logarithm of ``n``."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out, length = mix(hashes), 1
    powers: list[tuple[int, np.ndarray]] = []
    while length <= n:
        powers.append((length, out))
        if 2 * length > n:
            break
        out = mix(out[:-length] * np.uint64(0x9E3779B97F4A7C15) + out[length:] + np.uint64(length))
        length *= 2
    done, found = 0, None
    for size, part in reversed(powers):
        if done + size <= n:
            ahead = part[done:]
            count = len(hashes) - n + 1
            found = ahead[:count] if found is None else mix(found * np.uint64(0x9E3779B97F4A7C15) + ahead[:count] + np.uint64(size))
            done += size
    return found
