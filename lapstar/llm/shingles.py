"""Sets of five-word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from lapstar.llm.common import mix
from lapstar.llm.words import LOWER, SPACE, text_of, word_hashes, word_ranges

WORDS = 5
_FACTOR = np.uint64(0x9FB21C651E98DF25)
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and where each text's begin (one more entry).

    Words are runs of bytes other than white space, A-Z as a-z. A text with fewer words than a shingle has one
    shingle of all its words; a text without words has none.
    """
    data = LOWER[data]
    starts, ends = word_ranges(offsets, ~SPACE[data])
    words = word_hashes(data, starts, ends)
    n = len(offsets) - 1
    n_words = np.bincount(text_of(offsets, starts), minlength=n)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - WORDS + 1, 1), 0)
    first_word = np.concatenate([[0], np.cumsum(n_words)])
    first = np.concatenate([[0], np.cumsum(n_shingles)])
    at = np.arange(first[-1]) + np.repeat(first_word[:-1] - first[:-1], n_shingles)
    left = np.repeat(first_word[1:], n_shingles) - at  # words from here to the text's end
    size = np.minimum(left, WORDS)
    found = size.astype(np.uint64) * _LENGTH
    for k in range(WORDS):
        inside = slice(None) if len(words) and int(size.min(initial=WORDS)) > k else np.flatnonzero(size > k)
        found[inside] = found[inside] * _FACTOR + words[at[inside] + k]
    found = mix(found)
    parts, counts = [], np.zeros(n + 1, np.int64)
    for i in np.flatnonzero(n_shingles):
        own = np.sort(found[first[i] : first[i + 1]])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        parts.append(own)
        counts[i + 1] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(counts)


def digests(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit sums per text that tell its set from others, whatever the order of the members."""
    out = np.zeros((2, len(bounds) - 1), np.uint64)
    for row, key in enumerate((0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ np.uint64(key)), dtype=np.uint64)])
        out[row] = sums[bounds[1:]] - sums[bounds[:-1]]
    return out.view(np.int64)
