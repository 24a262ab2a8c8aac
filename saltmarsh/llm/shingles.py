"""Words and five-word shingles of whole texts as 64-bit hashes, in numpy.

A word is a run of characters other than ASCII white space. A text of one to four words has one
shingle, all its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE_WORDS = 5
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift) over an array, salted."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one after another, and where each text's begin (one more offset than texts)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(texts)
    flat, ends = parts.flatten(), np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False))))
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, bool)
    if not filled.all():
        ends = np.concatenate(([0], np.cumsum(filled)))[ends]
        flat = flat.filter(pa.array(filled))
    if not len(flat):
        return np.zeros(0, np.uint64), ends.astype(np.int64)
    coded = flat.dictionary_encode()
    unique = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_numpy(zero_copy_only=False)), np.uint64, len(coded.dictionary))
    return unique[coded.indices.to_numpy(zero_copy_only=False)], ends.astype(np.int64)


def shingle_hashes(words: np.ndarray, ends: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position on, text by text, and where each text's begin."""
    n = np.diff(ends)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    starts = np.concatenate(([0], np.cumsum(count))).astype(np.int64)
    if not starts[-1]:
        return np.zeros(0, np.uint64), starts
    # from each word on, whatever text the next words are of
    padded = np.concatenate((words, np.zeros(k, np.uint64)))
    total = np.zeros(len(words), np.uint64)
    for j in range(k):
        total = (total ^ (total >> np.uint64(29))) * _ODD[j % 5] + padded[j : j + len(words)]
    total = total[np.repeat(ends[:-1] - starts[:-1], count) + np.arange(starts[-1])]
    for i in np.flatnonzero((n > 0) & (n < k)).tolist():
        one = np.zeros(1, np.uint64)
        for j in range(k):
            one = (one ^ (one >> np.uint64(29))) * _ODD[j % 5] + (words[ends[i] + j] if j < n[i] else np.uint64(0))
        total[starts[i]] = one[0]
    return mixed(total), starts


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of one text, sorted."""
    return np.unique(shingle_hashes(*word_hashes(pa.array([text], pa.large_string())))[0])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct values; 0 where both are empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)
