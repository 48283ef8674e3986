"""Hashed words and five-word shingles of texts, with numpy over blocks of texts.

Words are runs of letters and digits of the lower-case text. A word's hash is a sum of its code
points times fixed odd 64-bit factors by place, then mixed; so is a shingle's, of its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
#: Characters and documents that are hashed at a time.
BLOCK_CHARS = 1 << 18

_WORD_CHAR: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose outputs look random (finalizer of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: np.ndarray | int, seed: int) -> np.ndarray:
    """Odd factors by place."""
    place = np.arange(n, dtype=np.uint64) if np.isscalar(n) else n.astype(np.uint64)
    return mix(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0x632BE59BD9B4E019 % 2**64)) | np.uint64(1)


def _is_word_char() -> np.ndarray:
    if not _WORD_CHAR:
        _WORD_CHAR.append(np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000))
    return _WORD_CHAR[0]


def _segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 from every start to the next."""
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts in order, and how many each text has."""
    texts = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _is_word_char()[codes]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    counts = np.zeros(len(texts), np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, ends_of_texts), prepend=0)
    chars = np.flatnonzero(inside)
    word = np.cumsum(begins[chars]) - 1
    place = chars - starts[word]
    products = (codes[chars].astype(np.uint64) + np.uint64(1)) * stream(place, 1)
    return mix(_segment_sums(products, np.flatnonzero(begins[chars]))), counts


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text: text number, hash, how often it occurs there; and each text's words.

    A text of one to four words has one shingle, of all its words.
    """
    words, counts = word_hashes(texts)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(texts)), counts)
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    left = (np.repeat(first + counts, counts) - np.arange(len(words)))  # words from here to the text's end
    factors = stream(SHINGLE, 2)
    h = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        h += np.where(left > k, padded[k:k + len(words)], np.uint64(0)) * factors[k]
    starts_here = (left >= SHINGLE) | ((np.repeat(counts, counts) < SHINGLE) & (left == np.repeat(counts, counts)))
    h, text = mix(h[starts_here]), text[starts_here]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(at, append=len(h)), counts


def sequence_digests(texts_words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of every text's words in order."""
    first = np.cumsum(counts) - counts
    place = np.arange(len(texts_words)) - np.repeat(first, counts)
    digests = []
    for seed in (3, 4):
        sums = np.zeros(len(counts), np.uint64)
        full = counts > 0
        if full.any():
            sums[full] = _segment_sums(texts_words * stream(place, seed), first[full])
        digests.append(mix(sums + counts.astype(np.uint64)))
    return digests[0], digests[1]


def blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about BLOCK_CHARS characters together, and the number of the first."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) + 1
        if held >= BLOCK_CHARS:
            yield start, texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts given as sorted shingle hashes and their counts."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    both = (b[0][at] == a[0]) if len(b[0]) else np.zeros(len(a[0]), bool)
    shared = np.minimum(a[1][both], b[1][at[both]]).sum()
    union = a[1].sum() + b[1].sum() - shared
    return float(shared / union) if union else 0.0
