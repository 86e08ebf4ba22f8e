"""Texts in chunks of bounded size, and set questions the chunks ask each other by key.

Documents are dealt by a hash of doc_id into chunks of about CHUNK_BYTES. A chunk sends sorted 64-bit
keys, cut into ranges, to the task of each range; there the keys of all chunks meet, and each chunk
gets one bit back for each key it sent. A key that a chunk holds many times, say a passage of a
third of all documents, is sent once. What moves is a few bytes for each key (differences of sorted
keys, stored by byte planes that compress) and an eighth of a byte back; the texts move once.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import pieces, power_of_two, text_bytes
from .words import text_list

CHUNK_BYTES = 4_000_000
RANGE_BYTES = 16_000_000
ASKED = "chunk bigint, range bigint, keys binary"
TOLD = "chunk bigint, range bigint, bits binary"


def packed_ints(values):
    """Unsigned integers as byte planes, without the planes that are all 0."""
    values = np.ascontiguousarray(values, dtype="<u8")
    planes = values.view(np.uint8).reshape(-1, 8).T
    used = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return np.array([len(values), used], "<u4").tobytes() + planes[:used].tobytes()


def unpacked_ints(data, at=0):
    """The integers stored at a place, and where the next ones are."""
    n, used = (int(x) for x in np.frombuffer(data, "<u4", 2, at))
    planes = np.zeros((n, 8), dtype=np.uint8)
    planes[:, :used] = np.frombuffer(data, np.uint8, n * used, at + 8).reshape(used, n).T
    return planes.reshape(-1).view("<u8").astype(np.uint64), at + 8 + n * used


def packed_sorted(keys):
    return packed_ints(np.diff(keys, prepend=np.uint64(0)))


def unpacked_sorted(data, at=0):
    steps, at = unpacked_ints(data, at)
    return np.cumsum(steps, dtype=np.uint64), at


def chunked(docs, chunk_bytes=CHUNK_BYTES):
    """(documents dealt into chunks, number of key ranges, bytes of text)."""
    size = text_bytes(docs)
    chunks = pieces(size, chunk_bytes)
    # Rows without doc_id take part in nothing; by their text they are spread like the others.
    spread = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))
    dealt = docs.select(F.pmod(spread, F.lit(chunks)).cast("bigint").alias("chunk"), "doc_id", "text")
    return dealt.repartition(chunks, "chunk"), power_of_two(pieces(size, RANGE_BYTES)), size


class Pack:
    """One chunk's rows in a fixed order: ids and texts; rank: the place of a row's id among the
    chunk's distinct ids, -1 without id."""

    def __init__(self, table):
        ids, texts = table["doc_id"].to_pylist(), text_list(table["text"])
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        known = [i for i in self.ids if i is not None]
        self.distinct = np.unique(np.array(known, dtype=np.int64))
        self.rank = np.full(len(ids), -1, dtype=np.int64)
        self.rank[:len(known)] = np.searchsorted(self.distinct, np.array(known, dtype=np.int64))


def by_range(keys, bits, ranges):
    """Where the keys (sorted, below 2**bits) of each range begin, and the end."""
    shift = bits - (ranges.bit_length() - 1)
    return np.searchsorted(keys >> np.uint64(shift), np.arange(ranges + 1, dtype=np.uint64))


def asked(chunk, keys, bits, ranges, extras=()):
    """Rows of ASKED for a chunk's sorted distinct keys, with a packing of each range of extras."""
    at = by_range(keys, bits, ranges)
    rows = [r for r in range(ranges) if at[r] < at[r + 1]]
    load = [
        packed_sorted(keys[at[r]:at[r + 1]]) + b"".join(packed_ints(e[at[r]:at[r + 1]]) for e in extras)
        for r in rows]
    return pa.table({
        "chunk": pa.array([chunk] * len(rows), pa.int64()), "range": pa.array(rows, pa.int64()),
        "keys": pa.array(load, pa.binary())})


def answered(keys, bits, ranges, told, width=1):
    """The bit (or row of width bits) of each key, from rows of TOLD; a range without a row has none set."""
    out = np.zeros(len(keys) if width == 1 else (len(keys), width), dtype=bool)
    at = by_range(keys, bits, ranges)
    for r, data in zip(told["range"].to_pylist(), told["bits"].to_pylist(), strict=True):
        n = at[r + 1] - at[r]
        out[at[r]:at[r + 1]] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).astype(bool).reshape(out[at[r]:at[r + 1]].shape)
    return out


def answers(judge, extras):
    """The task of a range: judge(keys, source, extras...) -> a bit, or a row of bits, for each key."""
    def answer(table):
        chunks, parts = table["chunk"].to_pylist(), []
        for data in table["keys"].to_pylist():
            keys, at = unpacked_sorted(data)
            row = [keys]
            for _ in range(extras):
                more, at = unpacked_ints(data, at)
                row.append(more)
            parts.append(row)
        sizes = [len(p[0]) for p in parts]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        source = np.repeat(np.arange(len(parts)), sizes)
        bits = judge(columns[0], source, *columns[1:])
        split = np.split(bits, np.cumsum(sizes)[:-1])
        some = [i for i, b in enumerate(split) if b.any()]
        return pa.table({
            "chunk": pa.array([chunks[i] for i in some], pa.int64()),
            "range": pa.array([table["range"][0].as_py()] * len(some), pa.int64()),
            "bits": pa.array([np.packbits(split[i]).tobytes() for i in some], pa.binary())})
    return answer


def asked_of(texts, ask):
    """ask(chunk, Pack) -> table of ASKED, for each chunk."""
    def run(key, table):
        return ask(key[0].as_py(), Pack(table))
    return texts.groupBy("chunk").applyInArrow(run, ASKED)


def with_answers(texts, told, use, schema):
    """use(chunk, Pack, its rows of TOLD) -> table of schema, for each chunk."""
    def run(key, left, right):
        return use(key[0].as_py(), Pack(left), right)
    return texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)


def question(told, number):
    """The answers to one of several questions, told apart by numbered()."""
    ranges = np.array(told["range"].to_pylist(), dtype=np.int64)
    chosen = told.filter(pa.array(ranges >> 40 == number))
    return chosen.set_column(1, "range", pa.array(ranges[ranges >> 40 == number] & (1 << 40) - 1, pa.int64()))


def numbered(told, number):
    return told.withColumn("range", F.col("range") + F.lit(number << 40))


def told_by(requests, judge, extras):
    return requests.groupBy("range").applyInArrow(answers(judge, extras), TOLD)


def key_bits(total, spare=9):
    """Bits of a filter key so that one in 2**spare looks up another's by chance."""
    return min(64, max(24, int(total).bit_length() + spare))
