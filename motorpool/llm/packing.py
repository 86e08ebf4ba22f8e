"""Best-fit packing of documents into sequences of several permitted lengths.

A document longer than the largest length is cut into pieces of that length and a rest. Pieces are
dealt into shards of about SHARD_TOKENS, each packed by itself: longest first, into the open bin with
the least room that still holds the piece. Where none does, a bin is opened of the size with the
least cost, the empty share that the pieces still waiting are expected to leave in it: all sizes are
weighed by filling them, largest waiting piece first, on the histogram of lengths. At the end each
bin is downsized to the smallest permitted length that holds its contents.

Every token of every document is in exactly one place. Memory of a shard is a few integers for each
of its pieces, at most SHARD_TOKENS of them (more only where one document alone is longer).

Results in special cases: a null or empty text and one without words has length 0 and takes no
place: no row. Rows that repeat a doc_id, or lack one, are packed each by itself. Ties go by doc_id.
"""

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import pieces, saved
from .words import text_list, word_spans

CAPACITIES = (512, 1024, 2048, 4096)
SHARD_TOKENS = 20_000_000
_PACKED = "shard int, bin int, capacity int, offset int, doc_id bigint, piece int, start bigint, length int"


def _counted(batches):
    for batch in batches:
        words = [len(word_spans(np.frombuffer(t, np.uint8))[0]) for t in text_list(batch["text"])]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(words, pa.int64())], names=["doc_id", "n"])


class _Waiting:
    """Lengths of the pieces not yet placed, most frequent use: the largest that fits."""

    def __init__(self, lengths):
        self.counts = {}
        for n in lengths:
            self.counts[n] = self.counts.get(n, 0) + 1
        self.sizes = sorted(self.counts)

    def take(self, n):
        self.counts[n] -= 1
        if not self.counts[n]:
            del self.counts[n]
            self.sizes.pop(bisect.bisect_left(self.sizes, n))

    def filled(self, room, taken):
        """What a room would hold if filled with the largest waiting pieces that fit."""
        left, used, above = room, {taken: 1}, room
        left -= taken
        while left:
            at = bisect.bisect_right(self.sizes, min(left, above)) - 1
            if at < 0:
                break
            n = self.sizes[at]
            fit = min(left // n, self.counts[n] - used.get(n, 0))
            left -= fit * n
            above = n - 1
        return room - left


def pack(lengths, capacities=CAPACITIES):
    """Bin and offset of each length (none above the largest capacity), and the bins' capacities."""
    capacities = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    waiting = _Waiting(lengths)
    rooms, by_room = [], {}  # the rooms of open bins in order, and the bins that have them
    placed, used = [None] * len(lengths), []

    def put(bin_, room):
        if room:
            if room not in by_room:
                bisect.insort(rooms, room)
                by_room[room] = []
            by_room[room].append(bin_)

    for i in order:
        n = lengths[i]
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            bin_ = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
        else:
            fits = capacities[bisect.bisect_left(capacities, n):]
            # Least cost: the smallest share of the bin left empty; then the shortest bin, the
            # cheaper one to attend over.
            room = min(fits, key=lambda c: (1 - waiting.filled(c, n) / c, c))
            bin_ = len(used)
            used.append(0)
        placed[i] = (bin_, used[bin_])
        used[bin_] += n
        waiting.take(n)
        put(bin_, room - n)
    return placed, [capacities[bisect.bisect_left(capacities, u)] for u in used]


def _pack_shard(capacities):
    def run(table):
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table["length"].to_pylist()
        placed, sizes = pack(lengths, capacities)
        bins = [b for b, _ in placed]
        return pa.table({
            "shard": table["shard"].cast(pa.int32()), "bin": pa.array(bins, pa.int32()),
            "capacity": pa.array([sizes[b] for b in bins], pa.int32()),
            "offset": pa.array([o for _, o in placed], pa.int32()), "doc_id": table["doc_id"],
            "piece": table["piece"], "start": table["start"], "length": table["length"]})
    return run


def packed(docs, length=None, capacities=CAPACITIES, shard_tokens=SHARD_TOKENS):
    """(shard, bin, capacity, offset, doc_id, piece, start, length): where each piece of each row of
    docs goes; start and length are in units of length, a bigint column (words of text if None)."""
    most = max(capacities)
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    if length is None:
        sized = docs.select(ids, "text").mapInArrow(_counted, "doc_id bigint, n bigint")
    else:
        sized = docs.select(ids, length.cast("bigint").alias("n"))
    sized = saved(sized)  # two numbers a row; the text isn't read again
    total = sized.agg(F.sum("n")).first()[0] or 0
    cut = sized.where("n > 0").select(
        "doc_id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {most}"))).alias("k"))
    shards = pieces(total, shard_tokens)
    parts = cut.select(
        F.pmod(F.xxhash64("doc_id", "n", "k"), F.lit(shards)).cast("int").alias("shard"), "doc_id",
        F.col("k").cast("int").alias("piece"), (F.col("k") * most).alias("start"),
        F.least(F.lit(most), F.col("n") - F.col("k") * most).cast("int").alias("length"))
    return parts.groupBy("shard").applyInArrow(_pack_shard(tuple(capacities)), _PACKED)
