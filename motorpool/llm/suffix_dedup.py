"""Repeated byte strings across documents, by enhanced suffix arrays and their common-prefix intervals.

A suffix array over a whole corpus fits nowhere, so equal strings are first brought together:

1. Each window of `length` bytes names its anchor, the least-hashed stretch of 24 bytes in it. Equal
   windows name equal anchors, and neighbouring windows mostly share one; the bytes of the windows
   that name the same anchor are a region. Anchors of one document only are set aside.
2. Regions that are the same byte for byte are told once, by the chunk of their least doc_id; all
   other documents lose them whole. What is left is one copy of each distinct region, and only where
   an anchor has several: the places where copies differ, and passages in different surroundings.
3. Those regions go, by their anchor, to the task of a key range: it builds the suffix array with
   longest common prefixes, scans it with a stack for the intervals of common prefix `length` or
   more, and tests that their occurrences differ on the left. These are the maximal repeats, each
   with all occurrences; of every window the least doc_id keeps it.

Results in special cases: a null or empty text has no bytes, one below `length` bytes no window.
Rows that repeat a doc_id are one document: equal strings among them remove nothing. A row without
doc_id is kept whole and removes nothing. Removal works on bytes and may cut a UTF-8 character; the
kept bytes are returned as binary.
"""

import hashlib

import numpy as np
import pyarrow as pa

from .chunks import (
    ASKED, TOLD, answered, asked, asked_of, by_range, chunked, key_bits, numbered, packed_ints, question,
    told_by, unpacked_ints, with_answers,
)
from .words import joined, mix, powers, prefix_sums, slice_hashes

LENGTH = 50
GRAM = 24
CHUNK_BYTES = 2_000_000
BLOCK = 1 << 14
_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _numbers(data):
    """The eight bytes from each place on as a number, the first byte leading."""
    out = np.empty(len(data) - 7, dtype=np.uint64)
    for k in range(8):
        here = data[k:k + (len(data) - k) // 8 * 8].view(">u8")
        out[k::8] = here[:len(out[k::8])]
    return out


def suffix_array(strings, least):
    """(string, offset, common prefix with the one before) of all suffixes of at least `least`
    bytes, in order of their bytes (a prefix first); strings as a list of bytes."""
    most = max(map(len, strings), default=0)
    data, at = joined(strings)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    counts = np.maximum(sizes - least + 1, 0)
    owner = np.repeat(np.arange(len(strings)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start, left = at[owner] + offset, sizes[owner] - offset
    # Eight bytes at a time, as numbers that order like the bytes; past the end of a string: 0.
    data = np.concatenate([data, np.zeros(most + 16, np.uint8)])
    words, columns = _numbers(data), []
    for step in range(0, most, 8):
        beyond = np.clip(8 - (left - step), 0, 8).astype(np.uint64) * np.uint64(8)
        word = words[start + step] >> np.minimum(beyond, np.uint64(63)) << np.minimum(beyond, np.uint64(63))
        word[beyond == 64] = 0
        columns.append(word)
    order = np.lexsort([left, *columns[::-1]])
    prefix = np.zeros(len(order), dtype=np.int64)
    same = np.arange(1, len(order))  # places that equal the one before so far
    for word in columns:
        differ = word[order[same]] ^ word[order[same - 1]]
        equal = differ == 0
        apart = differ[~equal].astype(">u8").view(np.uint8).reshape(-1, 8) > 0
        prefix[same[~equal]] += apart.argmax(axis=1)
        same = same[equal]
        prefix[same] += 8
    if len(order):
        prefix[1:] = np.minimum(prefix[1:], np.minimum(left[order[1:]], left[order[:-1]]))
    return owner[order], offset[order], prefix


def intervals(prefix, least):
    """(common prefix, first, end) of every common-prefix interval of at least `least`, inner ones
    first: a scan with a stack of the open intervals."""
    out, stack = [], []
    long = np.flatnonzero(prefix >= least)
    values, before = prefix[long].tolist(), None
    for i, value in zip(long.tolist(), values, strict=True):
        if before is not None and i != before + 1:
            out += [(v, first, before + 1) for v, first in reversed(stack)]
            stack = []
        first = i - 1
        while stack and stack[-1][0] > value:
            v, first = stack.pop()
            out.append((v, first, i))
        if not stack or stack[-1][0] < value:
            stack.append((value, first))
        before = i
    if before is not None:
        out += [(v, first, before + 1) for v, first in reversed(stack)]
    return out


def _left(strings, owner, offset):
    """The byte before each suffix; at the start of a string a value of its own."""
    data, at = joined(strings)
    return np.where(offset > 0, data[np.maximum(at[owner] + offset - 1, 0)].astype(np.int64), -1 - owner)


def maximal_repeats(strings, least=LENGTH):
    """(length, [(string, offset), ...]) of each maximal repeat of at least `least` bytes: all its
    occurrences, of which two differ in the byte before (the start of a string differs from all)."""
    owner, offset, prefix = suffix_array(strings, least)
    left = _left(strings, owner, offset)
    return [
        (length, list(zip(owner[a:b].tolist(), offset[a:b].tolist(), strict=True)))
        for length, a, b in intervals(prefix, least) if (left[a:b] != left[a]).any()]


def _window_minima(values, size):
    """The least of each run of `size` values."""
    span, out = 1, values
    while 2 * span <= size:
        out = np.minimum(out[:len(out) - span], out[span:])
        span *= 2
    return np.minimum(out[:len(values) - size + 1], out[size - span:]) if size > span else out


class _Regions:
    """The regions of a chunk's documents with an id, in order."""

    def __init__(self, pack, length):
        self.length, self.ids = length, pack.distinct
        texts = [t if r >= 0 else b"" for t, r in zip(pack.texts, pack.rank, strict=True)]
        self.data, self.at = joined(texts)
        self.sums = prefix_sums(self.data)
        n, wide = len(self.data), length - GRAM + 1
        self.anchor = self.first = self.last = self.rank = np.zeros(0, dtype=np.int64)
        self.key = np.zeros(0, dtype=np.uint64)
        ends = self.at[1:] - length  # after the last window start, without the line feed between texts
        long = ends > self.at[:-1]
        if not long.any():
            return
        anchor = self._anchors(n - length + 1, wide)
        inside = np.zeros(n - length + 2, dtype=np.int8)
        inside[self.at[:-1][long]] += 1
        inside[ends[long]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = anchor[1:] != anchor[:-1]
        new[self.at[:-1][long]] = True
        new &= inside
        self.first = np.flatnonzero(new)
        text = np.searchsorted(self.at, self.first, side="right") - 1
        # First and last window start.
        self.last = np.minimum(np.append(self.first[1:], len(anchor)), ends[text]) - 1
        self.anchor = anchor[self.first].astype(np.int64)
        self.key = mix(self._grams(self.anchor, self.anchor + GRAM, self.anchor))
        self.rank = pack.rank[text]

    def _grams(self, first, end, power):
        raw = self.sums[end] - self.sums[first]
        raw *= powers(len(self.data) + 1, inverse=True)[power]
        return mix(raw)

    def _anchors(self, windows, wide):
        """The anchor of each window start, block by block: what a block needs stays in the processor's cache."""
        out = np.empty(windows, dtype=np.uint32)
        for a in range(0, windows, BLOCK):
            b = min(a + BLOCK, windows)
            grams = b - a + wide - 1
            named = self._grams(slice(a, a + grams), slice(a + GRAM, a + grams + GRAM), slice(a, a + grams))
            # The place in the low half makes the least value name it, the first one on a tie.
            named &= np.uint64(0xFFFFFFFF00000000)
            named |= np.arange(a, a + grams, dtype=np.uint64)
            out[a:b] = _window_minima(named, wide) & np.uint64(0xFFFFFFFF)
        return out

    def only(self, which):
        self.first, self.last, self.anchor, self.key, self.rank = (
            x[which] for x in (self.first, self.last, self.anchor, self.key, self.rank))

    def identity(self):
        """A hash of a region's bytes and the place of the anchor in it."""
        return mix(slice_hashes(self.sums, self.first, self.last + self.length) + (self.anchor - self.first).astype(np.uint64))

    def unsigned(self, rank):
        return self.ids[rank].view(np.uint64) ^ np.uint64(2**63)


def _groups(*columns):
    """(order, first of each group of equal rows in that order, group of each row)."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def _distinct_anchors(regions, bits):
    """(short key of each region, distinct ones in order, 1 where several documents have it)."""
    short = regions.key >> np.uint64(64 - bits)
    order = np.argsort(short, kind="stable")  # the regions lie by rank
    ordered, rank = short[order], regions.rank[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else order
    last = np.append(first[1:], len(order)) - 1 if len(order) else order
    return short, ordered[first], (rank[first] != rank[last]).astype(np.uint64)


def _judge_anchors(keys, source, several):
    order, first, group = _groups(keys)
    sizes = np.bincount(group)
    return ((sizes > 1) | (np.bincount(group, several) > 0))[group]


def _judge_regions(keys, source, second, ids):
    """Two bits: a smaller doc_id has the same region; the anchor has other regions too."""
    order, first, group = _groups(keys, second)
    least = np.minimum.reduceat(ids[order], first) if len(order) else ids
    _, _, anchor = _groups(keys)
    pairs = np.unique(np.stack([anchor, group], axis=1), axis=0)
    variants = np.bincount(pairs[:, 0])
    return np.stack([ids > least[group], variants[anchor] > 1], axis=1)


def _judge_windows(length):
    """Bits for the windows of all regions of a range, from their common-prefix intervals."""
    def judge(table):
        strings, ids, rows = [], [], []
        for data in table["keys"].to_pylist():
            sizes, at = unpacked_ints(data)
            own, at = unpacked_ints(data, at)
            for size in sizes.tolist():
                strings.append(data[at:at + size])
                at += size
            ids.append(own)
            rows.append(len(sizes))
        ids = np.concatenate(ids)
        owner, offset, prefix = suffix_array(strings, length)
        windows = np.array([len(s) - length + 1 for s in strings])
        at = np.cumsum(windows) - windows
        place, owned, left = at[owner] + offset, ids[owner], _left(strings, owner, offset)
        # In each maximal repeat the least id keeps; the others lose all windows of the repeat.
        # (Two equal windows lie in the maximal repeat that their common surroundings grow to.)
        steps = np.zeros(windows.sum() + 1, dtype=np.int32)
        for common, a, b in intervals(prefix, length):
            if (left[a:b] != left[a]).any():
                lost = place[a:b][owned[a:b] > owned[a:b].min()]
                np.add.at(steps, lost, 1)
                np.add.at(steps, lost + (common - length + 1), -1)
        bits = np.cumsum(steps[:-1]) > 0
        ends = np.cumsum(rows)
        cut = np.cumsum(windows)
        out = np.split(bits, [cut[e - 1] for e in ends[:-1]])
        return pa.table({
            "chunk": table["chunk"], "range": table["range"],
            "bits": pa.array([np.packbits(b).tobytes() for b in out], pa.binary())})
    return judge


def _shared(regions, bits, ranges, told):
    """Keeps the regions whose anchor several documents have; sorts them for the second question."""
    short, distinct, _ = _distinct_anchors(regions, bits)
    known = distinct[answered(distinct, bits, ranges, told)]
    at = np.minimum(np.searchsorted(known, short), max(0, len(known) - 1))
    regions.only(known[at] == short if len(known) else np.zeros(len(short), dtype=bool))
    identity = regions.identity()
    order, first, group = _groups(regions.key, identity)
    least = np.minimum.reduceat(regions.rank[order], first) if len(order) else regions.rank
    return group, regions.key[order][first], identity[order][first], least, order[first]


def _contested(regions, group, keys, ranges, told):
    """(regions lost whole, by group; groups to compare in the suffix array)."""
    said = answered(keys, 64, ranges, told, 2)
    return said[:, 0], np.flatnonzero(~said[:, 0] & said[:, 1])


def repeats_removed(docs, length=LENGTH):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row of docs (doc_id, text)."""
    texts, ranges, size = chunked(docs, CHUNK_BYTES)
    bits = key_bits(size, 7)

    def ask_anchors(chunk, pack):
        _, distinct, several = _distinct_anchors(_Regions(pack, length), bits)
        return asked(chunk, distinct, bits, ranges, [several])

    def ask_regions(chunk, pack, told):
        regions = _Regions(pack, length)
        _, keys, identity, least, _ = _shared(regions, bits, ranges, told)
        return asked(chunk, keys, 64, ranges, [identity, regions.unsigned(least)])

    def ask_windows(chunk, pack, told):
        regions = _Regions(pack, length)
        group, keys, _, least, sample = _shared(regions, bits, ranges, question(told, 0))
        _, compare = _contested(regions, group, keys, ranges, question(told, 1))
        at, load, rows = by_range(keys[compare], 64, ranges), [], []
        ids = regions.unsigned(least)
        for r in range(ranges):
            some = compare[at[r]:at[r + 1]]
            if len(some):
                parts = [regions.data[regions.first[i]:regions.last[i] + length].tobytes() for i in sample[some]]
                sizes = np.array([len(p) for p in parts], dtype=np.uint64)
                load.append(packed_ints(sizes) + packed_ints(ids[some]) + b"".join(parts))
                rows.append(r)
        return pa.table({
            "chunk": pa.array([chunk] * len(rows), pa.int64()), "range": pa.array(rows, pa.int64()),
            "keys": pa.array(load, pa.binary())})

    def gone(regions, told):
        """(first, end) of the stretches to remove, which may overlap."""
        group, keys, _, least, _ = _shared(regions, bits, ranges, question(told, 0))
        lost, compare = _contested(regions, group, keys, ranges, question(told, 1))
        said = question(told, 2)
        at = by_range(keys[compare], 64, ranges)
        sizes = np.zeros(len(keys), dtype=np.int64)
        sizes[group] = regions.last - regions.first + 1
        # Runs of lost windows of the groups that were compared, in order of their group.
        of, begin, stop = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for r, data in zip(said["range"].to_pylist(), said["bits"].to_pylist(), strict=True):
            some = compare[at[r]:at[r + 1]]
            ends = np.cumsum(sizes[some])
            flags = np.zeros(int(ends[-1]) + len(some) + 1, dtype=np.int8)  # with a 0 after each group
            owner = np.repeat(np.arange(len(some)), sizes[some])
            flags[1 + np.arange(int(ends[-1])) + owner] = np.unpackbits(np.frombuffer(data, np.uint8), count=int(ends[-1]))
            steps = np.diff(flags, append=np.int8(0))
            up, down = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
            run = owner[up - np.searchsorted(ends + np.arange(1, len(some) + 1), up, side="right")]
            before = (ends - sizes[some] + np.arange(len(some)))[run]
            of.append(some[run])
            begin.append(up - before)
            stop.append(down - before)
        of, begin, stop = (np.concatenate(c) for c in (of, begin, stop))
        order = np.argsort(of, kind="stable")
        of, begin, stop = of[order], begin[order], stop[order]
        whole = lost[group] | (regions.rank > least[group])
        part = np.flatnonzero(~whole)
        low = np.searchsorted(of, group[part], side="left")
        runs = np.searchsorted(of, group[part], side="right") - low
        owner = np.repeat(part, runs)
        run = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(low, runs)
        first = np.append(regions.first[whole], regions.first[owner] + begin[run])
        last = np.append(regions.last[whole], regions.first[owner] + stop[run] - 1)
        return first, last + length

    def finish(chunk, pack, told):
        regions = _Regions(pack, length)
        steps = np.zeros(len(regions.data) + length + 1, dtype=np.int32)
        at = regions.at
        first, end = gone(regions, told)
        np.add.at(steps, first, 1)
        np.add.at(steps, end, -1)
        covered, rows = np.cumsum(steps) > 0, []
        for i, text in enumerate(pack.texts):
            if pack.rank[i] >= 0 and (mask := covered[at[i]:at[i] + len(text)]).any():
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                spans = int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1))
                n = int(mask.sum())
            else:
                kept, spans, n = text, 0, 0
            rows.append((pack.ids[i], len(text), n, spans, hashlib.sha256(kept).hexdigest(), kept))
        ids, *counts, sha, kept = zip(*rows, strict=True) if rows else [[]] * 6
        names = ("n_bytes", "n_removed", "n_spans")
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()),
            **{n: pa.array(c, pa.int64()) for n, c in zip(names, counts, strict=True)},
            "kept_sha256": pa.array(sha, pa.string()), "kept": pa.array(kept, pa.binary())})

    anchors = told_by(asked_of(texts, ask_anchors), _judge_anchors, 1)
    regions = told_by(with_answers(texts, anchors, ask_regions, ASKED), _judge_regions, 2)
    told = anchors.unionByName(numbered(regions, 1))
    windows = with_answers(texts, told, ask_windows, ASKED).groupBy("range").applyInArrow(_judge_windows(length), TOLD)
    return with_answers(texts, told.unionByName(numbered(windows, 2)), finish, _RESULT)
