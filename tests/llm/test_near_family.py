"""Families of near copies: few comparisons, no link lost; components grown link by link."""

import random

import numpy as np
import pytest

from motorpool.llm import components, near_dedup
from motorpool.llm.superminhash import parity_maps


def least_reachable(edges):
    least = {n: n for e in edges for n in e}
    for _ in least:
        for u, v in edges:
            least[u] = least[v] = min(least[u], least[v])
    return least


@pytest.mark.parametrize("task_edges", [8, 100_000])
def test_joined_components_equal_those_of_all_links(spark, monkeypatch, task_edges):
    monkeypatch.setattr(components, "_TASK_EDGES", task_edges)
    draw = random.Random(3)
    steps = [[(draw.randrange(60), draw.randrange(60)) for _ in range(n)] for n in (20, 15, 0, 12)]
    groups = components.components(spark.createDataFrame(steps[0], "u bigint, v bigint"))
    for k, links in enumerate(steps[1:], 2):
        groups = components.joined(groups, spark.createDataFrame(links, "u bigint, v bigint"))
        want = least_reachable([e for step in steps[:k] for e in step if e[0] != e[1]])
        got = [tuple(r) for r in groups.select("node", "component").collect()]
        assert len(got) == len(dict(got))
        assert dict(got) == want


def test_a_family_is_compared_about_once_a_class(spark, monkeypatch):
    draw = random.Random(11)
    words = [f"w{draw.randrange(5000)}" for _ in range(300)]
    texts = []
    for i in range(400):
        mine = list(words)
        for _ in range(4):
            mine[draw.randrange(300)] = f"x{i}y{draw.randrange(9)}"
        texts.append((1000 - i, " ".join(mine)))
    compared = []

    def counted(docs, pairs, *rest):
        compared.append(pairs.count())
        return confirmed(docs, pairs, *rest)

    confirmed = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", counted)
    docs = spark.createDataFrame([*texts, (5000, "quite another text of a few words")], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, size=2).collect()}
    assert got == {i: 601 for i, _ in texts} | {5000: 5000}
    assert sum(compared) < 2 * len(texts)


def test_parity_maps_never_differ_more_than_the_sets():
    draw = np.random.default_rng(4)
    for size, gone in [(1, 1), (40, 3), (300, 60), (3000, 900), (20, 0)]:
        pool = np.unique(draw.integers(0, 2**63, 2 * size + 5, dtype=np.uint64))
        sets = [np.sort(pool[:size]), np.sort(pool[gone:size + gone]), pool[:0]]
        maps = parity_maps(sets, 2048).view(np.uint64)
        apart = [int(np.bitwise_count(maps[0] ^ m).sum()) for m in maps[1:]]
        assert apart[0] <= 2 * gone and apart[1] <= size
        assert apart[0] >= 1.5 * min(gone, 60)
    assert parity_maps([], 2048).shape == (0, 32)


def test_small_tables_are_stored_in_few_parts(spark, monkeypatch):
    draw = random.Random(5)
    words = [f"w{draw.randrange(5000)}" for _ in range(200)]
    texts = [(i, " ".join([*words, f"x{i}"])) for i in range(60)] + [(100, "a text of its own"), (101, None)]
    parts = []

    def stored(df):
        parts.append((out := saved(df)).rdd.getNumPartitions())
        return out

    saved = near_dedup.saved
    monkeypatch.setattr(near_dedup, "saved", stored)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        docs = spark.createDataFrame(texts, "doc_id bigint, text string")
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, size=2).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == {i: 0 for i in range(60)} | {100: 100, 101: 101}
    assert max(parts) <= 8
