"""Sets of word shingles as sorted 64-bit hashes."""

import numpy as np

from .words import ASCII_LOWER, window_hashes, word_hashes


def shingle_sets(texts, size):
    """For each text its set: distinct runs of size words of the text in lower case (A-Z only);
    with fewer words the whole sequence is the one shingle; without words the set is empty."""
    words, owner = word_hashes([t.translate(ASCII_LOWER) for t in texts])
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    windows = window_hashes(words, size)
    sets = []
    for first, end in zip(bounds[:-1], bounds[1:], strict=True):
        n = end - first
        if n >= size:
            sets.append(np.unique(windows[first:end - size + 1]))
        elif n:
            sets.append(window_hashes(words[first:end], n))
        else:
            sets.append(words[:0])
    return sets


def linked(a, b, percent):
    """Whether 100 * |a & b| >= percent * |a | b|, for sets that aren't empty."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
