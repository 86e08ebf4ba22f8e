"""Periodic runs against a search over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motorpool.llm import periodic_runs
from motorpool.llm.queries import QUERIES, _repeated_tail

SF_DIR = "/root/testdata/sf0.001"


def all_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                # A run of a smaller period is longer on its own; the same stretch has its smallest period first.
                if not any(a <= s and i + q <= a + n and p < q for (a, p), n in found.items()):
                    found[s, q] = i + q - s
    return sorted((s, n, q) for (s, q), n in found.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *told, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def fixture():
    rng = np.random.default_rng(5)
    unit = [f"u{i}" for i in range(37)]
    texts = [
        None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "A a A a A a A a A",
        "x " * 2_000, " ".join(unit * 4), " ".join(unit * 4)[:-4], "w " + " ".join(unit * 9 + unit[:5]) + " v",
        " ".join((["a"] * 7 + ["b"]) * 6 + ["a"] * 9), " ".join((["a", "b"] * 5 + ["c"]) * 5), "é é é  " * 8,
        " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i % 700}" for i in range(3300)),
    ]
    texts += [" ".join(rng.choice(list("abc"), 300)) for _ in range(4)] + [" ".join(rng.choice(list("ab"), 500)) for _ in range(6)]
    rows = list(enumerate(texts, start=1))
    return rows + [(None, "z z z z z z z"), (3, "q " * 9), (3, "q " * 9), (-7, " ".join(unit * 5))]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_special_cases_equal_brute_force(spark):
    docs = spark.createDataFrame(fixture(), "doc_id bigint, text string").selectExpr(
        "*", "1 AS start", "'r' AS runs", "2 AS length", "'b' AS best")
    found = rows(periodic_runs.digests(periodic_runs.periodic_runs(docs, _repeated_tail)))
    assert found == sorted((expected(*r) for r in fixture()), key=repr)
    assert rows(periodic_runs.digests(periodic_runs.periodic_runs(docs.where("1 = 0")))) == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted((expected(*r) for r in docs), key=repr)
    assert sum(w[1] for w in wanted) > 10
    assert rows(QUERIES["op12_periodic_runs"](spark, SF_DIR)) == wanted


def test_words_kept_and_runs(spark):
    docs = spark.createDataFrame([(1, "k a b a b a b a b m")], "doc_id bigint, text string")
    (row,) = periodic_runs.periodic_runs(docs).collect()
    assert (row.n_words, [tuple(r) for r in row.runs], row.text) == (10, [(1, 8, 2)], "k a b m")


def test_very_long_text(spark):
    unit = " ".join(f"u{i}" for i in range(5_000))
    text = "x " * 300_000 + " ".join([unit] * 5) + " y" * 7
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    (row,) = periodic_runs.periodic_runs(docs).collect()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 1), (300_000, 25_000, 5_000), (325_000, 7, 1)]
    assert row.text == f"x {unit} y"


@pytest.mark.parametrize("letters", ["ab", "abc"])
@settings(max_examples=60, deadline=None)
@given(data=st.data())
def test_random_words(letters, data):
    """Repeated pieces in repeated pieces, so that runs of all scales meet."""
    piece = st.lists(st.sampled_from(letters), min_size=1, max_size=12)
    texts = []
    for _ in range(data.draw(st.integers(1, 3))):
        words = []
        for _ in range(data.draw(st.integers(1, 4))):
            inner = data.draw(piece) * data.draw(st.integers(1, 9)) + data.draw(piece)
            words += inner * data.draw(st.integers(1, 6))
        texts.append(words)
    _, counts, runs, _ = periodic_runs._judged([(None, " ".join(t).encode()) for t in texts], None, 6)
    assert counts == [len(t) for t in texts]
    assert [[tuple(r.values()) for r in own] for own in runs] == [all_runs(t) for t in texts]
