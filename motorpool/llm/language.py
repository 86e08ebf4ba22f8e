"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the byte n-grams of one to three bytes that
both hold, divided by the geometric mean of their numbers; n-grams are hashed to DIMENSIONS places.
Letters are lower-cased and runs of anything else become one space before. Nystroem landmarks, the
same number for each language, make the kernel a map into as many dimensions; one ridge regression
for each language against the rest is solved there, and texts are scored block by block as
presence matrix x landmarks x weights.

The scores of a text over all languages have a fixed sum, so the largest says which language is
nearest and not how near. That is judged apart: the share of the text's n-grams that are known in a
language (held by KNOWN_SHARE of its fitted rows). The fitted rows, each against the others of its
language, give a language's limit: NEAR_SHARE of the share that all but a twentieth of them reach. A
text is far if in every language it falls short of the limit by more than two standard errors for its
number of n-grams; one word is hardly ever far. A language of fewer than LEAST_ROWS fitted rows takes
the least limit of the others; where no language has as many, no lettered text is far.

The fit takes at most PER_LANGUAGE rows of each language, those with the least hash of their doc_id,
and LANDMARKS of them; everything else runs over all rows.

Results in special cases: text that is null or without a letter is `und` with score 0, and so is
every text where nothing could be learned (empty table, no language given). Rows without doc_id count
as held out. Equal scores go to the language first in order. Columns lang_pred, score and near of the
input are replaced; all others are kept.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .words import text_list

DIMENSIONS = 1 << 14
PER_LANGUAGE = 250
LANDMARKS = 128
RIDGE = 1e-3
FOLDS = 5
KNOWN_SHARE = 0.01
NEAR_SHARE = 0.7
LEAST_ROWS = 5
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_BLOCK_BYTES = 1_000_000
_SPREAD = np.uint32(2654435761)

#: Other ASCII than letters becomes a space.
_PLAIN = np.array([b if b > 127 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint8)


def _place(codes, order):
    hashed = (codes * np.uint32(4) + np.uint32(order)) * _SPREAD
    return ((hashed ^ (hashed >> np.uint32(15))) * _SPREAD) >> np.uint32(32 - 14)


def presence(texts):
    """One row of DIMENSIONS bytes, 0 or 1, for each text (UTF-8)."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.uint8)
    for row, text in enumerate(texts):
        low = text.decode("utf-8", "replace").lower().encode()
        data = _PLAIN[np.frombuffer(b" " + low + b" ", dtype=np.uint8)]
        space = data == 32
        data = data[~(space & np.roll(space, 1))] if len(data) > 1 else data
        code = data.astype(np.uint32)
        for order in (1, 2, 3):
            out[row, _place(code, order)] = 1
            code = code[:-1] * np.uint32(256) + data[order:].astype(np.uint32)
    return out


def _kernel(rows, landmarks):
    left, right = rows.astype(np.float32, copy=False), landmarks.astype(np.float32)
    sizes = np.sqrt(np.outer(left.sum(axis=1), right.sum(axis=1)))
    return (left @ right.T) / np.maximum(sizes, 1)


def _known(rows):
    """(n-grams known in the language of these rows, limit of the share known; None for few rows)."""
    rows = rows[rows.any(axis=1)]  # an empty text says nothing
    counts, least = rows.sum(axis=0, dtype=np.int64), max(1, int(np.ceil(KNOWN_SHARE * len(rows))))
    if len(rows) < LEAST_ROWS:
        return counts >= least, None
    shares = [(counts[row] - 1 >= least).mean() for row in rows.astype(bool)]
    return counts >= least, NEAR_SHARE * float(np.quantile(shares, 0.05))


class KernelRidge:
    """Scores texts; holds the landmarks and each language's known n-grams as bits, the weights, the
    limits of the share known and the languages in order."""

    def __init__(self, languages, landmarks, weights, offsets, known):
        self.languages, self.bits = languages, np.packbits(landmarks, axis=1)
        self.weights, self.offsets = weights, offsets
        self.known = np.packbits([grams for grams, _ in known], axis=1)
        least = min((limit for _, limit in known if limit is not None), default=0.0)
        self.limits = np.array([least if limit is None else limit for _, limit in known])

    @classmethod
    def fit(cls, rows, names, landmarks=LANDMARKS, ridge=RIDGE):
        languages = sorted(set(names))
        target = np.array([[1.0 if n == l else -1.0 for l in languages] for n in names])
        each = max(1, landmarks // len(languages))
        chosen = np.concatenate([np.flatnonzero(np.array(names) == l)[:each] for l in languages])
        k_mm = _kernel(rows[chosen], rows[chosen]).astype(np.float64)
        values, vectors = np.linalg.eigh(k_mm)
        root = vectors / np.sqrt(np.maximum(values, 1e-6))
        mapped = _kernel(rows, rows[chosen]).astype(np.float64) @ root
        weight = 1.0 / np.array([names.count(n) for n in names])  # every language counts alike
        weight /= weight.sum()
        centre, offsets = weight @ mapped, weight @ target
        spread = (mapped - centre) * weight[:, None]
        gram = spread.T @ (mapped - centre) + ridge * np.eye(mapped.shape[1])
        solved = np.linalg.solve(gram, spread.T @ (target - offsets))
        known = [_known(rows[np.array(names) == l]) for l in languages]
        return cls(languages, rows[chosen], root @ solved, offsets - centre @ solved, known)

    def score(self, texts):
        """The language, a score of 0 to 1, and whether any language is near, of each text."""
        landmarks = np.unpackbits(self.bits, axis=1)[:, :DIMENSIONS]
        rows = presence(texts).astype(np.float32)
        given = _kernel(rows, landmarks).astype(np.float64) @ self.weights + self.offsets
        best = given.argmax(axis=1)
        known = np.unpackbits(self.known, axis=1)[:, :DIMENSIONS].astype(np.float32)
        held, n = (rows @ known.T).astype(np.float64), rows.sum(axis=1, dtype=np.float64)[:, None]
        near = (held >= n * self.limits - 2 * np.sqrt(n * self.limits * (1 - self.limits))).any(axis=1)
        return [self.languages[b] for b in best], np.clip((given.max(axis=1) + 1) / 2, 0, 1), near


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(True))


def _presence_bits(batches):
    for batch in batches:
        bits = np.packbits(presence(text_list(batch["text"])), axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch["lang"], pa.array([b.tobytes() for b in bits], pa.binary())], names=["lang", "bits"])


def fit(docs, per_language=PER_LANGUAGE, landmarks=LANDMARKS):
    """A KernelRidge from the rows that aren't held out, or None where there are none."""
    learn = docs.where(~_held_out()).where("lang IS NOT NULL AND text IS NOT NULL")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = (
        learn.select("doc_id", "lang").withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= per_language).select("doc_id", "lang").distinct())
    # The sample is bounded by its parameters, and so is what comes back of it.
    rows = (
        learn.select("doc_id", "lang", "text").join(F.broadcast(sample), ["doc_id", "lang"])
        .orderBy(F.xxhash64("doc_id"), "doc_id").select("lang", "text")
        .mapInArrow(_presence_bits, "lang string, bits binary").collect())
    if not rows:
        return None
    bits = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in rows]), axis=1)
    return KernelRidge.fit(bits[:, :DIMENSIONS], [r["lang"] for r in rows], landmarks)


def _scorer(model):
    def score(columns):
        for column in columns:
            texts = text_list(column)
            lettered = [bool(_LETTER.search(t.decode("utf-8", "replace"))) for t in texts]
            names, scores, near = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            todo = [i for i, yes in enumerate(lettered) if yes and model is not None]
            while todo:
                block, held = [], 0
                while todo and (not block or held + len(texts[todo[-1]]) <= _BLOCK_BYTES):
                    block.append(todo.pop())
                    held += len(texts[block[-1]])
                found, scores[block], near[block] = model.score([texts[i] for i in block])
                for i, name in zip(block, found, strict=True):
                    names[i] = name
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores), pa.array(near)], ["lang_pred", "score", "near"])
    return score


def identified(docs, model):
    """docs with lang_pred and score of each whole text, and near: whether any learned language is."""
    from collections.abc import Iterator

    score = _scorer(model)
    score.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    predict = F.arrow_udf(score, "struct<lang_pred string, score double, near boolean>")
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "near")]
    scored = docs.select(*kept, predict("text").alias("\0found"))
    return scored.select(*kept, F.col("\0found.lang_pred"), F.col("\0found.score"), F.col("\0found.near"))


def languages(docs, per_language=PER_LANGUAGE, landmarks=LANDMARKS):
    """(doc_id, held_out, lang_pred, score) for each row of docs (doc_id, text, lang)."""
    found = identified(docs.select("doc_id", "text"), fit(docs, per_language, landmarks))
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")
