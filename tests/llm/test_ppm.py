"""Scores by partial matching against a plain trie of dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorpool.llm import ppm
from motorpool.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text)) + [None]


class Trie:
    def __init__(self, order):
        self.order, self.after = order, defaultdict(Counter)

    def steps(self, text):
        coded = [255] * self.order + list(lowered(text).encode()) + [255]
        for i in range(self.order, len(coded)):
            yield coded[i - self.order:i], coded[i]

    def learn(self, text):
        for context, symbol in self.steps(text):
            for k in range(self.order + 1):
                self.after[tuple(context[self.order - k:])][symbol] += 1

    def probability(self, context, symbol):
        p, out = 1.0, set()
        for k in range(self.order, -1, -1):
            counts = self.after.get(tuple(context[self.order - k:]))
            if counts is None:
                continue
            left = {s: c for s, c in counts.items() if s not in out}
            n, d = sum(left.values()), len(left)
            if symbol in left:
                return p * left[symbol] / (n + d)
            if d:
                p *= d / (n + d)
            out |= set(left)
        return p / (256 - len(out))

    def score(self, text):
        return sum(math.log10(self.probability(c, s)) for c, s in self.steps(text))


def expected(rows, order):
    learned = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    trie, counts = Trie(order), Counter()
    for t in learned:
        trie.learn(t)
        counts.update(words(t))
    total, distinct, out = sum(counts.values()), len(counts), []
    for i, t in rows:
        own = words(t)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        held = i is None or zlib.crc32(str(i).encode()) % 7 == 2
        out.append((i, held, len(own), sum(counts[w] > 0 for w in own), total, base, trie.score(t)))
    return sorted(out, key=repr)


def fixture():
    rng = np.random.default_rng(3)
    pieces = ["ba", "Na", "ter", " ", " ", "é", "\n", "q", "."]
    rows = [(i, "".join(rng.choice(pieces, 60))) for i in range(40)]
    rows += [(40 + i, "the same Text of all") for i in range(6)]
    rows += [(50, None), (51, ""), (52, " \t\n"), (None, "nobody learns this"), (None, None), (53, "x"), (53, "x"), (53, "x y")]
    rows += [(54, "abc " * 700), (55, "日本語のテキスト 日本"), (56, "A" * 3000), (57, "zyxw vuts"), (58, "ÿ\u0080 ")]
    return rows


def same(found, wanted):
    found = sorted((tuple(r) for r in found.collect()), key=lambda r: repr(r[:5]))
    wanted = sorted(wanted, key=lambda r: repr(r[:5]))
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    key = lambda r: (repr(r[:5]), r[6])
    for a, b in zip(sorted(found, key=key), sorted(wanted, key=key), strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-11, abs=1e-11)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture(), "doc_id bigint, text string").selectExpr(
        "*", "1 AS chunk", "2 AS salt", "true AS learn", "'x' AS load", "3 AS range")


@pytest.mark.parametrize(("order", "chunk_bytes", "salted"), [(4, 4_000_000, 1024), (4, 700, 2), (2, 300, 1), (5, 2_000, 3)])
def test_scores_equal_a_plain_trie(docs, order, chunk_bytes, salted):
    found = ppm.scored(docs, ~ppm.held_out(7, 2), order, chunk_bytes, salted)
    same(found, expected(fixture(), order))


def test_long_texts_are_scored_in_pieces():
    texts = [lowered(t).encode() for _, t in fixture()]
    keys, counts = ppm._pair_counts(texts, np.ones(len(texts), dtype=bool), 4)
    own = list(ppm._parts(texts, 4, 8))
    assert max(len(k) for _, _, k in own) <= 256
    again, n = np.unique(np.concatenate([k for _, _, k in own]), return_counts=True)
    assert (keys == again).all() and (counts == n).all()


def test_very_long_text(spark):
    text = "ab " * 700_000
    docs = spark.createDataFrame([(1, text), (2, "ab ab")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in ppm.scored(docs, F.lit(True)).collect()}
    assert found[1].n_tokens == 700_001 and found[1].n_known == 700_001
    assert 0 > found[1].score > -20  # all but the first places cost next to nothing


def test_probabilities_add_up_to_one():
    trie = Trie(3)
    for t in ("banana bandana", "banal", "ananas"):
        trie.learn(t)
    texts = [b"banana bandana", b"banal", b"ananas"]
    keys, counts = ppm._pair_counts(texts, np.ones(3, dtype=bool), 3)
    short = np.zeros(65536, dtype=np.int64)
    for _, _, own in ppm._parts(texts, 1):
        np.add.at(short, own.astype(np.int64), 1)
    for context in ("ana", "xyz", "ban", "zan", "zza"):
        code = sum(b << 8 * (2 + 1 - k) for k, b in enumerate(context.encode()[::-1]))
        asked = np.arange(code, code + 256, dtype=np.uint64)
        # One range that holds all contexts stands for those of each pair of bytes.
        logs = ppm.log_probabilities(asked, ppm.levels(keys, counts, short.reshape(256, 256), 3))
        assert (10 ** logs).sum() == pytest.approx(1, abs=1e-12)
        assert 10 ** logs[ord("a")] == pytest.approx(trie.probability(list(context.encode()), ord("a")))


def test_nothing_to_learn(docs):
    found = ppm.scored(docs.where("doc_id = 57"), F.lit(False)).collect()
    (row,) = found
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
    assert row.score == pytest.approx(-10 * math.log10(256))
    assert ppm.scored(docs.where("1 = 0"), F.lit(True)).collect() == []


def test_query_equals_a_plain_trie(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_ppm_score"](spark, SF_DIR)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(found, expected(rows, ppm.ORDER))


def test_held_out_texts_cost_less_than_by_single_bytes(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    learned = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(b for t in learned for b in [*lowered(t).encode(), 255])
    cost = {b: math.log10(n / sum(counts.values())) for b, n in counts.items()}
    rows = QUERIES["op11_ppm_score"](spark, SF_DIR).where("held_out").collect()
    assert len(rows) > 10
    for r in rows:
        single = sum(cost.get(b, -6.0) for b in [*lowered(texts[r.doc_id]).encode(), 255])
        assert r.score > single or r.n_tokens < 20
    # Over the held-out texts the model needs less than two thirds of those digits.
    total = sum(cost.get(b, -6.0) for r in rows for b in [*lowered(texts[r.doc_id]).encode(), 255])
    assert sum(r.score for r in rows) > 0.67 * total
