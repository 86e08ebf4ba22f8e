"""Exact repeats of WINDOW words across documents, by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of 7 words, the index. A run of 13 words
covers at least one whole block of the document it stands in, so a run shared by two documents holds
a block of the one somewhere in the other. All rolling windows of 7 words probe the index, as short
hashes: only an anchor, a window that is a block of some document and stands in another too, can be
part of a repeat. Around its anchors each document extends the hits: the runs of 13 words that hold
an anchor are compared by 128-bit hashes across documents, and neighbouring hits join to maximal
exact repeats. Per run only the least doc_id counts: it keeps its words, all others lose theirs.

Results in special cases: a null or empty text has no words. Rows that repeat a doc_id are one
document: equal runs among them remove nothing. A row without doc_id is kept whole and removes
nothing. With 13 words or fewer than that a text has one run or none.
"""

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa

from .chunks import (
    ASKED, answered, asked, asked_of, chunked, key_bits, numbered, question, told_by, with_answers,
)
from .words import window_hashes, word_hashes

WINDOW = 13
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string"


class _Windows:
    """The words of a chunk's documents with an id: hashes, rank and place of each word."""

    def __init__(self, pack, window, bits):
        self.window, self.block = window, (window + 1) // 2
        self.bits = bits
        self.words, self.row = word_hashes([t if r >= 0 else b"" for t, r in zip(pack.texts, pack.rank, strict=True)])
        self.rank = pack.rank[self.row]
        self.bounds = np.searchsorted(self.row, np.arange(len(pack.texts) + 1))
        self.place = np.arange(len(self.words)) - self.bounds[self.row]
        self.ids = pack.distinct

    def whole(self, size):
        """Where runs of size words start that end in the same row."""
        n = max(0, len(self.words) - size + 1)
        return self.row[:n] == self.row[size - 1:]

    def probes(self):
        """(starts of all rolling windows of block length, their short hashes)."""
        starts = np.flatnonzero(self.whole(self.block))
        return starts, window_hashes(self.words, self.block)[starts] >> np.uint64(64 - self.bits)

    def runs(self, anchor_starts):
        """(starts of the runs that hold an anchor, their two hashes)."""
        marks = np.zeros(len(self.words) + 1, dtype=np.int32)
        marks[anchor_starts + 1] = 1
        upto = np.cumsum(marks)
        whole = self.whole(self.window)
        n, span = len(whole), self.window - self.block + 1
        starts = np.flatnonzero(whole & (upto[span:span + n] > upto[:n]))
        return starts, window_hashes(self.words, self.window)[starts], window_hashes(self.words, self.window, 1)[starts]


def _distinct_probes(w):
    """(starts, hashes, distinct hashes in order, flags: 1 a block here, 2 in several documents)."""
    starts, hashes = w.probes()
    order = np.lexsort((w.rank[starts], hashes))
    sorted_hashes, rank = hashes[order], w.rank[starts][order]
    first = np.flatnonzero(np.diff(sorted_hashes, prepend=~sorted_hashes[:1]) != 0)
    if not len(first):
        return starts, hashes, sorted_hashes, np.zeros(0, np.uint64)
    last = np.append(first[1:], len(order)) - 1
    block = np.logical_or.reduceat(w.place[starts][order] % w.block == 0, first)
    return starts, hashes, sorted_hashes[first], block + 2 * (rank[first] != rank[last]).astype(np.uint64)


def _judge_anchors(keys, source, flags):
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]) != 0)
    sizes = np.diff(np.append(first, len(order)))
    met = np.bitwise_or.reduceat(flags[order], first)
    anchor = (met & np.uint64(1) > 0) & ((sizes > 1) | (met & np.uint64(2) > 0))
    out = np.zeros(len(keys), dtype=bool)
    out[order] = np.repeat(anchor, sizes)
    return out


def _judge_runs(keys, source, second, ids):
    """Set where a smaller doc_id has the run; ids are shifted to be unsigned and ordered."""
    order = np.lexsort((ids, second, keys))
    a, b, least = keys[order], second[order], ids[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(order)))
    out = np.zeros(len(keys), dtype=bool)
    out[order] = least > np.repeat(least[first], sizes)
    return out


def _anchors(w, told, ranges):
    starts, hashes, distinct, _ = _distinct_probes(w)
    known = distinct[answered(distinct, w.bits, ranges, told)]
    if not len(known):
        return starts[:0]
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return starts[known[at] == hashes]


def _distinct_runs(w, anchors):
    """(starts, group of each, first hash, second hash and least rank of each group, in order)."""
    starts, one, two = w.runs(anchors)
    order = np.lexsort((w.rank[starts], two, one))
    a, b = one[order], two[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return starts, group, a[first], b[first], w.rank[starts][order][first]


def _removed(w, told, ranges):
    """Mask over the words of w."""
    starts, group, one, _, least = _distinct_runs(w, _anchors(w, question(told, 0), ranges))
    elsewhere = answered(one, 64, ranges, question(told, 1))
    gone = starts[elsewhere[group] | (w.rank[starts] > least[group])] if len(starts) else starts
    steps = np.zeros(len(w.words) + w.window + 1, dtype=np.int32)
    np.add.at(steps, gone, 1)
    np.add.at(steps, gone + w.window, -1)
    return np.cumsum(steps)[:len(w.words)] > 0


def repeats_removed(docs, window=WINDOW):
    """(doc_id, n_words, n_removed, kept_sha256, text) for each row of docs (doc_id, text): words of
    repeats taken out, the others joined by a space."""
    texts, ranges, size = chunked(docs)
    bits = key_bits(size)

    def ask_anchors(chunk, pack):
        _, _, distinct, flags = _distinct_probes(_Windows(pack, window, bits))
        return asked(chunk, distinct, bits, ranges, [flags])

    def ask_runs(chunk, pack, told):
        w = _Windows(pack, window, bits)
        _, _, one, two, least = _distinct_runs(w, _anchors(w, told, ranges))
        ids = w.ids[least].view(np.uint64) ^ np.uint64(2**63)
        return asked(chunk, one, 64, ranges, [two, ids])

    def finish(chunk, pack, told):
        w = _Windows(pack, window, bits)
        removed, rows = _removed(w, told, ranges), []
        for i, text in enumerate(pack.texts):
            words = text.split()
            gone = removed[w.bounds[i]:w.bounds[i + 1]]
            kept = b" ".join(compress(words, (~gone).tolist())) if gone.any() else b" ".join(words)
            rows.append((pack.ids[i], len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
        ids, n, m, sha, kept = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n, pa.int64()),
            "n_removed": pa.array(m, pa.int64()), "kept_sha256": pa.array(sha, pa.string()),
            "text": pa.array(kept, pa.string())})

    anchors = told_by(asked_of(texts, ask_anchors), _judge_anchors, 1)
    runs = told_by(with_answers(texts, anchors, ask_runs, ASKED), _judge_runs, 2)
    both = anchors.unionByName(numbered(runs, 1))
    return with_answers(texts, both, finish, _RESULT)
