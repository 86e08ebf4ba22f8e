"""Periodic runs of words, by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4 q) words long, that
no neighbouring word extends with that period. The words of many documents are laid end to end, with a
separator of its own after each document, and all scales go over them at once.

At scale t (4, 8, 16, ...) every position has the fingerprint of its next t words. A position belongs
to the synchronising set if the least fingerprint of the t + 1 positions from it on is its own or that of
the last of them: this depends on 2 t words only, so equal contexts are chosen alike, and every
stretch of t positions holds a chosen one. In a run with a period q of t to 2 t - 1 the chosen positions
come back after q words, and the next equal context of 2 t words after one of them is that one. Such
pairs propose q; comparing the words themselves, left and right of the pair, confirms the run and
finds its ends.

Highly periodic regions are detected apart: periods of 1 to 3 by comparing each word with
the word that far ahead. At a larger scale, positions whose t words have a period of t / 4 or less lie in
a run found before; they are left out of the choice, which keeps the sets sparse, and those runs supply
the small periods that the pairs there would omit.

Results in special cases: a null or empty text, or one of separators only, has no words and no run. Rows
that repeat a doc_id are judged each on its own. A row without doc_id is judged like any other.
Ties do not arise: two runs with the same start have different periods. A text of any length is one task's
work, in time n log n and memory in proportion to it. Other columns of the input are not read. An
empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .words import mix, text_list

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
FIRST_SCALE = 4

_FOUND = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string"
_BLOCK_BYTES = 2_000_000
_NONE = np.uint64(2**64 - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _stretches(equal):
    """(starts, ends) of the stretches of True."""
    steps = np.diff(equal.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _small_periods(words):
    """Runs (start, end, period) with periods below FIRST_SCALE, by direct comparison."""
    out = []
    for period in range(1, FIRST_SCALE):
        if len(words) <= period:
            break
        starts, ends = _stretches(words[:-period] == words[period:])
        enough = ends - starts >= (LEAST_EXPONENT - 1) * period
        for s, e in zip(starts[enough].tolist(), ends[enough].tolist(), strict=True):
            # A smaller period of so long a stretch divides this one: 1, as it is a prime here.
            if period == 1 or (words[s:s + period] != words[s]).any():
                out.append((s, e + period, period))
    return out


def _least_ahead(values, scale):
    """The least of scale + 1 values from each place on, where there are as many."""
    least, width = values, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:len(values) - scale], values[scale:])


def _synchronising(prints, scale, runs):
    """The synchronising set: positions with 2 * scale words ahead, by the fingerprints of scale words."""
    periodic = np.zeros(len(prints) + 1, dtype=np.int32)
    for start, end, period in runs:
        if LEAST_EXPONENT * period <= scale <= end - start:
            periodic[start] += 1
            periodic[end - scale + 1] -= 1
    values = np.where(np.cumsum(periodic[:-1]) > 0, _NONE, prints)
    least = _least_ahead(values, scale)
    return np.flatnonzero((least != _NONE) & ((values[:-scale] == least) | (values[scale:] == least)))


def _extended(words, at, period):
    """The stretch (start, end) of places around at whose word comes again period words later."""
    end, step, last = at, 32, len(words) - period
    while end < last:
        other = words[end:min(end + step, last)] != words[end + period:min(end + step, last) + period]
        first = int(other.argmax())
        if other[first]:
            end += first
            break
        end, step = end + len(other), step * 2
    start, step = at, 32
    while start > 0:
        low = max(0, start - step)
        other = (words[low:start] != words[low + period:start + period])[::-1]
        first = int(other.argmax())
        if other[first]:
            start -= first
            break
        start, step = low, step * 2
    return start, end


def find_runs(words, longest):
    """Runs (start, end, period) of LEAST_EXPONENT periods or more in an integer array; longest: of its
    documents, which are set apart by values that occur once."""
    runs = _small_periods(words)
    scale = 1
    with np.errstate(over="ignore"):
        prints = mix(words.astype(np.uint64) + _STEP)
        while LEAST_EXPONENT * scale <= longest:
            doubled = mix(prints[:-scale] * _STEP + prints[scale:]) if len(prints) > scale else prints[:0]
            if scale >= FIRST_SCALE and len(doubled):
                chosen = _synchronising(prints, scale, runs)
                contexts = doubled[chosen]
                order = np.argsort(contexts, kind="stable")
                at, context = chosen[order], contexts[order]
                period = np.diff(at)
                pair = (context[1:] == context[:-1]) & (period >= scale) & (period < 2 * scale)
                places, periods = at[:-1][pair], period[pair]
                order = np.lexsort((places, periods))
                done = {}
                for place, q in zip(places[order].tolist(), periods[order].tolist(), strict=True):
                    if place < done.get(q, 0):
                        continue
                    start, end = _extended(words, place, q)
                    done[q] = max(end, place + 1)
                    if end - start >= (LEAST_EXPONENT - 1) * q:
                        runs.append((start, end + q, q))
            prints, scale = doubled, 2 * scale
    return runs


def _judged(rows, prepare, least_length):
    """Rows of _FOUND for (doc_id, text) pairs."""
    ids, pieces, counts = {}, [], []
    for doc_id, text in rows:
        own = np.array([ids.setdefault(w, len(ids)) for w in text.split()], dtype=np.int64)
        if prepare is not None and len(own):
            taken = prepare(doc_id, len(own))
            own = own if taken is None else own[taken]
        pieces += [own, np.array([-1 - len(counts)])]
        counts.append(len(own))
    words, bounds = np.concatenate(pieces), np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(np.array(counts) + 1, out=bounds[1:])
    runs = sorted(r for r in find_runs(words, max(counts)) if r[1] - r[0] >= least_length)
    gone = np.zeros(len(words) + 1, dtype=np.int32)
    for start, end, period in runs:
        gone[start + period] += 1
        gone[end] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    owner = np.searchsorted(bounds, [r[0] for r in runs], side="right") - 1
    of = [[] for _ in counts]
    for row, (start, end, period) in zip(owner.tolist(), runs, strict=True):
        of[row].append({"start": start - int(bounds[row]), "length": end - start, "period": period})
    names = list(ids)
    texts = []
    for row, n in enumerate(counts):
        a = bounds[row]
        texts.append(b" ".join([names[w] for w in words[a:a + n][kept[a:a + n]].tolist()]).decode())
    return [[doc_id for doc_id, _ in rows], counts, of, texts]


def _blocks(ids, texts):
    block, held = [], 0
    for row in zip(ids, texts, strict=True):
        if block and held + len(row[1]) > _BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row[1])
    if block:
        yield block


def periodic_runs(docs, prepare=None, least_length=LEAST_LENGTH):
    """(doc_id, n_words, runs, text) for each row of docs (doc_id, text): its runs by start and period,
    and its words joined by a space, without those that a run holds after its first period.

    prepare(doc_id, n) may give, for a text of n > 0 words, the places of the words to judge instead.
    """
    types = [pa.int64(), pa.int64(), pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])), pa.string()]

    def run(batches):
        for batch in batches:
            for block in _blocks(batch["doc_id"].to_pylist(), text_list(batch["text"])):
                columns = _judged(block, prepare, least_length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_words", "runs", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, _FOUND)


def digests(found):
    """The longest run (ties: smallest start, then period) and digests of rows of periodic_runs()."""
    key = F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    told = found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.array_max(key).alias("best"),
        F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"), "text")
    return told.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.col("best.length") * -1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
