"""Scores of a language model: prediction by partial matching over bytes, and a word model beside it.

The trie of all byte contexts of up to ORDER bytes holds how often each byte followed in the texts
that the model learns from. A text is coded byte by byte and closed by an end symbol (255, which UTF-8
never holds; it also stands for what comes before a text). The longest context is asked first: a symbol
it has seen c times has the probability c / (n + d), of n symbols counted, d of them distinct; any
other one costs an escape, d / (n + d), and the context without its oldest byte is asked, from whose
counts the symbols just ruled out are excluded. A context never seen costs nothing. Below the empty
context the symbols not seen at all share the rest. The score is the sum of the log10 probabilities. ASCII
letters are lower-cased before.

Texts are dealt into chunks. A chunk sends each distinct (context, symbol) once with its count, most
recent byte first, to the range of the last two bytes; so all contexts of two bytes and more that a range
holds are whole there, and the counts of the shorter ones are one table of 256 x 256. Counts of SALTED
chunks are added before the range sees them. The range works out the log10 probability of every pair it
was told, and each chunk gets back those it asked for. Word counts go the same way, by 64-bit digests of
the words. So neither model is ever in one place; a range holds 1/RANGES of the distinct pairs, or those of
its most frequent two bytes.

Results in special cases: a null or empty text, or one without words, is one token, the end; its score is that of the
end symbol. A row whose learn is null is held out. Where nothing is learned each symbol has probability 1/256
and the base score is 0. Rows that repeat a doc_id are scored each on its own and learned each;
equal texts have equal scores. A text of any length is scored whole, in pieces of bounded size. An empty
table gives no rows. Other columns of the input are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .chunks import packed_ints, packed_sorted, unpacked_ints, unpacked_sorted
from .shared import pieces
from .words import ASCII_LOWER, mix, text_list

ORDER = 5
CHUNK_BYTES = 8_000_000
#: Places of a text that are sorted at once.
BLOCK_BITS = 22
#: Chunks whose counts are added, and who are answered, by one task for each range.
SALTED = 1024
RANGES = 256
END = 255

_ASKED = "chunk bigint, range int, salt bigint, load binary"
_COUNTED = "range int, load binary"
_SCORED = """doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,
    base_score double, score double"""
_WORDS, _TEXTS, _BYTES = 1 << 16, (1 << 16) + 1, (1 << 16) + 2


def _lowered(column):
    return [t.translate(ASCII_LOWER) for t in text_list(column)]


def _place_bits(order):
    """Bits that a key leaves in 64 for a place in a block."""
    return min(BLOCK_BITS, 64 - 8 * (order + 1))


def _parts(texts, order, bits=BLOCK_BITS):
    """Bounded blocks of the coded texts: (row of each piece, its first place, keys of all places).

    A key is a context, most recent byte highest, and below it the symbol that follows.
    """
    room = 1 << bits
    most = room // 2

    def keys(block):
        data = np.frombuffer(b"".join(piece for _, piece in block), dtype=np.uint8)
        sizes = np.array([len(piece) for _, piece in block])
        starts = np.cumsum(sizes) - sizes
        out = data[order:].astype(np.uint64)
        for back in range(1, order + 1):
            out |= data[order - back:len(data) - back].astype(np.uint64) << np.uint64(8 * (order + 1 - back))
        whole = np.ones(len(data), dtype=bool)
        for k in range(order):
            whole[starts + k] = False
        return np.array([row for row, _ in block]), starts - order * np.arange(len(block)), out[whole[order:]]

    block, held = [], 0
    for row, text in enumerate(texts):
        coded = bytes([END]) * order + text + bytes([END])
        for at in range(0, len(coded) - order, most):
            piece = coded[at:at + most + order]
            if held + len(piece) > room:
                yield keys(block)
                block, held = [], 0
            block.append((row, piece))
            held += len(piece)
    if block:
        yield keys(block)


def _summed(keys, counts):
    """Distinct keys in order, and the sum of each one's counts."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]) != 0)
    return ordered[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _pair_counts(texts, learn, order):
    """The distinct keys of all texts, and how often each comes in those to learn from."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for rows, starts, own in _parts(texts, order):
        told = np.repeat(learn[rows], np.diff(starts, append=len(own)))
        for chosen, weight in ((own[told], 1), (own[~told], 0)):
            ordered = np.sort(chosen)
            first = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]) != 0)
            keys.append(ordered[first])
            counts.append(np.diff(first, append=len(ordered)).astype(np.uint64) * np.uint64(weight))
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _pair_ranges(keys, order):
    return (mix(keys >> np.uint64(8 * (order - 1))) & np.uint64(RANGES - 1)).astype(np.int64)


class _Words:
    """The distinct words of a chunk by their digests, and each text's words as places among them."""

    def __init__(self, texts):
        ids = {}
        self.rows = [np.array([ids.setdefault(w, len(ids)) for w in t.split()], dtype=np.int64) for t in texts]
        digests = np.array(
            [int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "big") for w in ids], dtype=np.uint64)
        self.keys, place = np.unique(digests, return_inverse=True)
        self.rows = [place[r] for r in self.rows]

    def counts(self, learn):
        used = [r for r, yes in zip(self.rows, learn, strict=True) if yes]
        return np.bincount(np.concatenate([np.zeros(0, np.int64), *used]), minlength=len(self.keys)).astype(np.uint64)


def _word_ranges(keys):
    return (keys >> np.uint64(56)).astype(np.int64)


def _by_range(ranges):
    """The order of keys by range, and where each range begins in it and ends."""
    order = np.argsort(ranges, kind="stable")
    return order, np.searchsorted(ranges[order], np.arange(RANGES + 1))


def _ask(order, salts):
    def ask(key, table):
        chunk, texts = key[0].as_py(), _lowered(table["text"])
        learn = np.array(table["learn"].to_pylist(), dtype=bool)
        rows, loads = [], []
        words = _Words(texts)
        keys, counts = _pair_counts(texts, learn, order)
        # Every chunk asks all ranges of words: each tells how many distinct ones it knows.
        for base, own, n, ranges in (
                (0, words.keys, words.counts(learn), _word_ranges(words.keys)),
                (RANGES, keys, counts, _pair_ranges(keys, order))):
            by, at = _by_range(ranges)
            own, n = own[by], n[by]
            for r in range(RANGES):
                if base == 0 or at[r] < at[r + 1]:
                    rows.append(base + r)
                    loads.append(packed_sorted(own[at[r]:at[r + 1]]) + packed_ints(n[at[r]:at[r + 1]]))
        return pa.table({
            "chunk": pa.array([chunk] * len(rows), pa.int64()), "range": pa.array(rows, pa.int32()),
            "salt": pa.array([chunk % salts] * len(rows), pa.int64()), "load": pa.array(loads, pa.binary())})
    return ask


def _merged(loads):
    keys, counts = [], []
    for load in loads:
        own, at = unpacked_sorted(load)
        keys.append(own)
        counts.append(unpacked_ints(load, at)[0])
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _add(key, table):
    keys, counts = _merged(table["load"].to_pylist())
    return pa.table({
        "range": pa.array([key[0].as_py()], pa.int32()),
        "load": pa.array([packed_sorted(keys) + packed_ints(counts)], pa.binary())})


class _Level:
    """The trie's nodes of one depth: contexts with their counts, and each symbol seen after them."""

    def __init__(self, codes, counts, longer=None):
        """codes: context * 256 + symbol, distinct and in order; longer: the level one byte deeper."""
        self.codes, self.counts = codes, counts
        contexts = codes >> np.uint64(8)
        first = np.flatnonzero(np.diff(contexts, prepend=~contexts[:1]) != 0)
        self.contexts = contexts[first]
        self.total = np.add.reduceat(counts, first) if len(first) else counts[:0]
        self.distinct = np.diff(first, append=len(codes)).astype(np.float64)
        self.first = first
        if longer is not None:
            # What the symbols of each longer context count for here: they are excluded after its escape.
            parents = ((longer.codes >> np.uint64(16)) << np.uint64(8)) | (longer.codes & np.uint64(255))
            held = counts[np.searchsorted(codes, parents)] if len(parents) else counts[:0]
            longer.excluded = np.add.reduceat(held, longer.first) if len(held) else held

    def find(self, contexts):
        """(place of each context, whether it is there)."""
        at = np.minimum(np.searchsorted(self.contexts, contexts), max(0, len(self.contexts) - 1))
        return at, (self.contexts[at] == contexts if len(self.contexts) else np.zeros(len(contexts), dtype=bool))

    def count(self, codes):
        if not len(self.codes):
            return np.zeros(len(codes))
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.counts[at], 0.0)


def levels(keys, counts, short, order):
    """The trie by depth, 0 to order, of the learned keys of a range; short: counts of byte pairs everywhere."""
    learned = counts > 0
    keys, counts = keys[learned], counts[learned].astype(np.float64)
    out = [None] * (order + 1)
    for depth in range(order, -1, -1):
        if depth > 1:
            codes = ((keys >> np.uint64(8 * (order + 1 - depth))) << np.uint64(8)) | (keys & np.uint64(255))
            codes, n = _summed(codes, counts)
        else:
            table = (short if depth else short.sum(axis=0)).reshape(-1)
            codes = np.flatnonzero(table).astype(np.uint64)
            n = table[codes.astype(np.int64)].astype(np.float64)
        out[depth] = _Level(codes, n, out[depth + 1] if depth < order else None)
    return out


def log_probabilities(keys, trie):
    """log10 of the probability of each key's symbol after its context."""
    order = len(trie) - 1
    out, todo = np.zeros(len(keys)), np.arange(len(keys))
    left_out, fewer = np.zeros(len(keys)), np.zeros(len(keys))
    for depth in range(order, -1, -1):
        level, own = trie[depth], keys[todo]
        context = own >> np.uint64(8 * (order + 1 - depth))
        at, seen = level.find(context)
        if seen.any():
            n, d = (np.where(seen, x[at], 0.0) for x in (level.total, level.distinct))
            n_left, d_left = n - left_out[todo], d - fewer[todo]
            c = np.where(seen, level.count((context << np.uint64(8)) | (own & np.uint64(255))), 0.0)
            known, escaped = c > 0, seen & (c == 0) & (d_left > 0)
            out[todo[known]] += np.log10(c[known] / (n_left + d_left)[known])
            out[todo[escaped]] += np.log10(d_left[escaped] / (n_left + d_left)[escaped])
            if depth:
                left_out[todo] = np.where(seen, level.excluded[at], 0.0)
                fewer[todo] = d
            todo = todo[~known]
    out[todo] -= np.log10(256 - len(trie[0].codes))
    return out


def _model(short, order):
    def model(key, table):
        keys, counts = _merged(table["load"].to_pylist())
        pairs = key[0].as_py() >= RANGES
        values = log_probabilities(keys, levels(keys, counts, short, order)) if pairs else counts.astype(np.float64)
        known = np.array([(counts > 0).sum()], dtype="<u8").tobytes()
        return pa.table({
            "range": pa.array([key[0].as_py()], pa.int32()),
            "load": pa.array([known + packed_sorted(keys) + values.tobytes()], pa.binary())})
    return model


def _answer(key, asked, model):
    load = model["load"][0].as_py()
    known, at = unpacked_sorted(load, 8)
    values = np.frombuffer(load, np.float64, len(known), at)
    out = [
        load[:8] + values[np.searchsorted(known, unpacked_sorted(own)[0])].tobytes()
        for own in asked["load"].to_pylist()]
    return pa.table({"chunk": asked["chunk"], "range": asked["range"], "load": pa.array(out, pa.binary())})


def _told(ranges, told):
    """(value of each key, by its range; sum of what the ranges know)."""
    order, at = _by_range(ranges)
    out, known = np.zeros(len(ranges)), 0
    for r, load in told:
        out[order[at[r]:at[r + 1]]] = np.frombuffer(load, np.float64, offset=8)
        known += int.from_bytes(load[:8], "little")
    return out, known


def _code_lengths(texts, keys, values, order):
    """The sum of the values of each text's keys, in the order of the text."""
    out, bits = np.zeros(len(texts)), np.uint64(_place_bits(order))
    for rows, starts, own in _parts(texts, order, _place_bits(order)):
        # Keys and places sorted as one integer.
        ordered = np.sort((own << bits) | np.arange(len(own), dtype=np.uint64))
        key, place = ordered >> bits, (ordered & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.diff(key, prepend=~key[:1]) != 0)
        found = np.empty(len(own))
        found[place] = np.repeat(values[np.searchsorted(keys, key[first])], np.diff(first, append=len(own)))
        np.add.at(out, rows, np.add.reduceat(found, starts))
    return out


def _finish(order, train_words, train_texts):
    train_tokens = train_words + train_texts

    def finish(key, table, told):
        texts, learn = _lowered(table["text"]), table["learn"].to_pylist()
        given = list(zip(told["range"].to_pylist(), told["load"].to_pylist(), strict=True))
        words = _Words(texts)
        counts, vocabulary = _told(_word_ranges(words.keys), [g for g in given if g[0] < RANGES])
        vocabulary += train_texts > 0  # the end
        keys, _ = _pair_counts(texts, np.zeros(len(texts), dtype=bool), order)
        values, _ = _told(_pair_ranges(keys, order), [(r - RANGES, load) for r, load in given if r >= RANGES])
        logs, known = np.log10(counts + 1), counts > 0
        n = np.array([len(r) + 1 for r in words.rows])
        base = np.array([logs[r].sum() for r in words.rows]) + np.log10(train_texts + 1)
        return pa.table({
            "doc_id": table["doc_id"], "held_out": pa.array([not x for x in learn], pa.bool_()),
            "n_tokens": pa.array(n, pa.int64()),
            "n_known": pa.array([int(known[r].sum()) + (train_texts > 0) for r in words.rows], pa.int64()),
            "train_tokens": pa.array([train_tokens] * len(texts), pa.int64()),
            "base_score": pa.array(base - n * np.log10(train_tokens + vocabulary + 1), pa.float64()),
            "score": pa.array(_code_lengths(texts, keys, values, order), pa.float64())})
    return finish


def _pairs_of(batches):
    """Counts of byte pairs, words and texts to learn from, and the bytes of all texts, of one task."""
    total = np.zeros(_BYTES + 1, dtype=np.int64)
    for batch in batches:
        texts, learn = _lowered(batch["text"]), np.array(batch["learn"].to_pylist(), dtype=bool)
        total[_BYTES] += sum(map(len, texts))
        chosen = [t for t, yes in zip(texts, learn, strict=True) if yes]
        total[_TEXTS] += len(chosen)
        total[_WORDS] += sum(len(t.split()) for t in chosen)
        for _, _, keys in _parts(chosen, 1):
            total[:_WORDS] += np.bincount(keys.astype(np.int64), minlength=_WORDS)
    code = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(total[code], pa.int64())], names=["code", "n"])


def scored(docs, learn, order=ORDER, chunk_bytes=CHUNK_BYTES, salted=SALTED):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs (doc_id,
    text). learn: a boolean column, the rows that both models learn from; order: 2 to 5 bytes of context.

    base_score adds log10((c + 1) / (N + V + 1)) over the words and the end: c the count of the word, N of
    all tokens, V of distinct ones among those learned.
    """
    told = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    # At most 256 x 256 pairs and three sums come back, whatever the size of the table.
    found = told.mapInArrow(_pairs_of, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(_BYTES + 1, dtype=np.int64)
    for row in found:
        total[row["code"]] = row["n"]
    short = total[:_WORDS].reshape(256, 256)
    chunks = pieces(int(total[_BYTES]) + 1, chunk_bytes)
    salts = pieces(chunks, salted)
    # Equal rows of one input partition share a chunk, those of several don't.
    spread = F.xxhash64("doc_id", "text", F.spark_partition_id())
    texts = told.withColumn("chunk", F.pmod(spread, F.lit(chunks)).cast("bigint")).repartition(chunks, "chunk")
    asked = texts.groupBy("chunk").applyInArrow(_ask(order, salts), _ASKED)
    added = asked.groupBy("range", "salt").applyInArrow(_add, _COUNTED)
    model = added.groupBy("range").applyInArrow(_model(short, order), _COUNTED)
    copies = model.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    answers = asked.groupBy("range", "salt").cogroup(copies.groupBy("range", "salt")).applyInArrow(
        _answer, "chunk bigint, range int, load binary")
    finish = _finish(order, int(total[_WORDS]), int(total[_TEXTS]))
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, _SCORED)


def held_out(folds, fold):
    """Rows whose crc32 of doc_id as text leaves fold when divided by folds."""
    return F.crc32(F.col("doc_id").cast("string")) % folds == fold
