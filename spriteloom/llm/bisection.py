"""Recursive graph bisection: an order in which documents with common terms stand together.

A set of documents is split into halves, and documents are swapped between them
as long as the logarithmic gaps of the terms' posting lists get smaller; both
halves are then split likewise.  The tree of splits is fitted on a bounded
sample.  Every other document goes down the same tree: at each split to the half
where its terms cost less, as the sample's halves have them.  Terms count as
FEATURES buckets of a hash, so that a tree has a bounded size.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

#: Buckets of terms, and levels of splits at most: a tree has 2**MAX_LEVELS * FEATURES numbers of four bytes, 16 MB.
FEATURES, MAX_LEVELS = 4096, 10
#: Documents of the sample for each leaf, and terms of a document that the fit looks at (those with the smallest buckets).
SAMPLE_PER_LEAF, SAMPLE_TERMS = 16, 512
#: Rounds of swaps at a split.
ROUNDS = 10


def features(terms) -> np.ndarray:
    """The buckets of terms (bytes)."""
    return np.fromiter((zlib.crc32(t) for t in terms), np.int64) % FEATURES


@dataclass(frozen=True)
class Tree:
    """Split ``k`` of level ``l`` is row ``2**l - 1 + k``: with a sum of ``scores`` below ``thresholds`` a document goes to the second half."""

    levels: int
    scores: np.ndarray
    thresholds: np.ndarray

    def leaf(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The leaf, in the order of the tree, of documents with so many buckets each."""
        of, node = np.repeat(np.arange(len(counts)), counts), np.zeros(len(counts), np.int64)
        for level in range(self.levels):
            at = 2**level - 1 + node
            sums = np.bincount(of, self.scores[at[of], buckets], len(counts))
            node = 2 * node + (sums < self.thresholds[at])
        return node


def _cost(degree: np.ndarray, n: int) -> np.ndarray:
    """Bits of the gaps of terms that so many of ``n`` documents have."""
    degree = np.maximum(degree, 0)
    return degree * np.log2(max(n, 1) / (degree + 1.0))


def _split(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """Which documents go to the first half, and the scores and threshold that tell so of others."""
    flat, of = np.concatenate(docs), np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    first = np.arange(len(docs)) < len(docs) // 2
    n1, n2 = int(first.sum()), int((~first).sum())
    for _ in range(ROUNDS):
        d1, d2 = np.bincount(flat[first[of]], minlength=FEATURES), np.bincount(flat[~first[of]], minlength=FEATURES)
        now = _cost(d1, n1) + _cost(d2, n2)
        leave, enter = now - _cost(d1 - 1, n1) - _cost(d2 + 1, n2), now - _cost(d1 + 1, n1) - _cost(d2 - 1, n2)
        gains = np.bincount(of, np.where(first[of], leave[flat], enter[flat]), len(docs))
        ones, twos = (np.flatnonzero(half)[np.argsort(-gains[half], kind="stable")] for half in (first, ~first))
        pairs = min(len(ones), len(twos))
        swap = gains[ones[:pairs]] + gains[twos[:pairs]] > 1e-9
        if not swap.any():
            break
        first[ones[:pairs][swap]], first[twos[:pairs][swap]] = False, True
    d1, d2 = np.bincount(flat[first[of]], minlength=FEATURES), np.bincount(flat[~first[of]], minlength=FEATURES)
    scores = ((_cost(d2 + 1, n2) - _cost(d2, n2)) - (_cost(d1 + 1, n1) - _cost(d1, n1))).astype(np.float32)
    sums = np.bincount(of, scores[flat], len(docs))
    return first, scores, float(np.median(sums))


def fit(docs: list[np.ndarray], levels: int) -> Tree:
    """The tree over a sample of documents, each given by its buckets; a set of fewer than two is not split, and its later documents all go one way."""
    docs = [np.sort(d)[:SAMPLE_TERMS] for d in docs if len(d)]
    scores, thresholds = np.zeros((2**levels - 1, FEATURES), np.float32), np.zeros(2**levels - 1)
    sets = [docs]
    for level in range(levels):
        halves = []
        for k, own in enumerate(sets):
            if len(own) < 2:
                halves += [own, []]
                continue
            first, scores[2**level - 1 + k], thresholds[2**level - 1 + k] = _split(own)
            halves += [[d for d, one in zip(own, first) if one], [d for d, one in zip(own, first) if not one]]
        sets = halves
    return Tree(levels, scores, thresholds)
