"""Hashed character n-grams of a vocabulary, computed for all its words at once."""

from __future__ import annotations

from functools import cache

import numpy as np

from tidemark.llm.words import Words, mix


@cache
def _alphanumeric() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def ngrams(vocabulary: list[str], sizes: tuple[int, ...], bits: int, marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of the lower-cased words.

    Anything but letters and digits ends a word, unless ``marks`` keeps it as a character.
    An n-gram may have a word's boundary at its ends, never inside.
    """
    if not vocabulary:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer("\n".join(vocabulary).lower().encode("utf-32-le"), np.uint32)
    word = np.cumsum(points == 10)
    inner = points != 10 if marks else _alphanumeric()[points]
    symbols = np.zeros(len(points) + 2, np.uint64)
    symbols[1:-1] = np.where(inner, points, 0)
    solid = symbols != 0
    buckets, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in sizes:
        count = len(symbols) - n + 1
        if count <= 0:
            continue
        ok = solid[1 : 1 + count] if n > 1 else solid[:count].copy()
        for i in range(2, n - 1):
            ok = ok & solid[i : i + count]
        at = np.flatnonzero(ok)
        code = np.full(len(at), n, np.uint64)
        for i in range(n):
            code = code * np.uint64(0x100000001B3) + symbols[at + i]
        buckets.append((mix(code) >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(word[np.minimum(at, len(word) - 1)] if n > 1 else word[at - 1])
    return np.concatenate(buckets), np.concatenate(owners)


#: Words whose n-grams are made at once in training.
CHUNK_WORDS = 20_000


def frequent(vocabulary: list[str], texts: np.ndarray, least: float, sizes: tuple[int, ...], bits: int, marks: bool = False):
    """The n-grams of a vocabulary whose words occur in at least ``least`` texts in sum (``texts``: by word).

    Returns the buckets, for each n-gram kept the index of its bucket and its word, and the
    number of all n-grams of each word.  The rare ones, most of all, are never held together.
    """
    parts = range(0, len(vocabulary), CHUNK_WORDS)
    seen, length = np.zeros(1 << bits), np.zeros(len(vocabulary))
    for i in parts:
        bucket, owner = ngrams(vocabulary[i : i + CHUNK_WORDS], sizes, bits, marks)
        seen += np.bincount(bucket, texts[i + owner], 1 << bits)
        length[i : i + CHUNK_WORDS] = np.bincount(owner, minlength=len(vocabulary[i : i + CHUNK_WORDS]))
    buckets, owners = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for i in parts:
        bucket, owner = ngrams(vocabulary[i : i + CHUNK_WORDS], sizes, bits, marks)
        keep = seen[bucket] >= least
        buckets.append(bucket[keep].astype(np.int32))
        owners.append((i + owner[keep]).astype(np.int32))
    names = np.flatnonzero(seen >= least)
    place = np.zeros(1 << bits, np.int32)
    place[names] = np.arange(len(names))
    return names, place[np.concatenate(buckets)], np.concatenate(owners), length


def text_sums(words: Words, per_word: np.ndarray) -> np.ndarray:
    """The sum over each text's words."""
    upto = np.concatenate([[0.0], np.cumsum(per_word[words.codes])])
    return upto[words.starts[1:]] - upto[words.starts[:-1]]
