"""Nearest neighbours by cosine: inverted lists, scanned with adaptive dimension sampling.

Unit vectors are dealt to the nearest of a set of centroids (spherical k-means, fitted on at most
SAMPLE rows, those with the least hash of vec_id; every row is listed). A query probes its PROBES
share of lists. There vectors and query are turned by one random rotation, after which each block of
columns is a fair sample of the squared distance: block by block, a candidate whose partial distance,
scaled up, exceeds the query's present 5th best by more than a test of EPSILON standard errors allows
is abandoned. Survivors are ranked by their cosine in double precision on the original vectors.

A list above PART_ROWS rows is split into parts by hash of vec_id, so copies of one vector don't
meet in one task; a query goes to all parts. Vectors of different lengths are never compared: lists
belong to one length. Broadcast: the centroids, at most LISTS for each length.

Results in special cases: rows whose vec_id or vector is null, and vectors that are empty, zero or
hold null or non-finite numbers, take no part. Rows that repeat a vec_id count once for each
distinct score, and are no candidates of a query of that id. Ties go to the smaller vec_id.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

SAMPLE = 20_000
LISTS = 1_024
ROWS_PER_LIST = 400
PROBES = 0.6
LEAST_PROBES = 32
PART_ROWS = 20_000
BLOCK = 16
EPSILON = 2.1
_LISTED = "dim int, list int, vec_id bigint, vector binary"
_FOUND = "query_id bigint, vec_id bigint, score double"


def _vectors(batch):
    """(ids, float64 vectors) of the rows of an Arrow batch that take part."""
    ids, out = [], []
    for i, v in zip(batch["vec_id"].to_pylist(), batch["embedding"], strict=True):
        if i is None or not v.is_valid or len(v.values) == 0 or v.values.null_count:
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            ids.append(i)
            out.append(x)
    return ids, out


def _unit(x):
    x = x / np.abs(x).max(axis=-1, keepdims=True)  # squares of very small or large numbers stay finite
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def _by_length(ids, vectors):
    lengths = np.array([len(v) for v in vectors], dtype=np.int64)
    for d in np.unique(lengths):
        some = np.flatnonzero(lengths == d)
        yield int(d), np.array(ids, dtype=np.int64)[some], np.array([vectors[i] for i in some])


def centroids(points, k, rounds=8, seed=5):
    """Unit centroids of unit points by spherical k-means; an empty one keeps its place."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(sizes > 0, sums / np.maximum(sizes, 1e-300), centres)
    return centres


def rotation(d, seed=11):
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def adaptive_scan(query, rows, k, block=BLOCK, epsilon=EPSILON, batch=1024):
    """Places of the rows (rotated unit vectors) that may be among the k nearest of query, and how
    many numbers were read. The first batch is read whole and sets the threshold."""
    d = len(query)
    best, kept, read = np.zeros(0), [], 0
    for first in range(0, len(rows), batch):
        alive = np.arange(first, min(first + batch, len(rows)))
        limit = best[k - 1] if len(best) >= k else np.inf
        partial = np.zeros(len(alive))
        for column in range(0, d, block):
            step = rows[alive, column:column + block] - query[column:column + block]
            partial += np.einsum("ij,ij->i", step, step)
            read += step.size
            seen = min(column + block, d)
            if seen < d and limit < np.inf:
                # Not far: the scaled partial distance is within the test of the limit.
                near = partial * (d / seen) <= limit * (1 + epsilon / np.sqrt(seen)) ** 2
                alive, partial = alive[near], partial[near]
        near = partial <= limit + 1e-9
        kept.append(alive[near])
        best = np.sort(np.concatenate([best, partial[near]]))[:k]
    return np.concatenate(kept) if kept else np.zeros(0, dtype=np.int64), read


def _assign(centres):
    def assign(batches):
        for batch in batches:
            for d, ids, x in _by_length(*_vectors(batch)):
                lists = (_unit(x) @ centres[d].T).argmax(axis=1) if d in centres else np.zeros(len(ids), np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), d), pa.int32()), pa.array(lists, pa.int32()),
                    pa.array(ids), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["dim", "list", "vec_id", "vector"])
    return assign


def _probe(centres, share, least):
    def probe(batches):
        for batch in batches:
            for d, ids, x in _by_length(*_vectors(batch)):
                centre = centres.get(d, np.ones((1, d)))
                n = min(len(centre), max(least, int(np.ceil(share * len(centre)))))
                near = np.argsort(-(_unit(x) @ centre.T), axis=1, kind="stable")[:, :n]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids) * n, d), pa.int32()), pa.array(near.reshape(-1), pa.int32()),
                    pa.array(np.repeat(ids, n)), pa.array([v.tobytes() for v in x for _ in range(n)], pa.binary())],
                    names=["dim", "list", "vec_id", "vector"])
    return probe


def _search(k):
    def search(queries, rows):
        out = ([], [], [])
        if len(queries) and len(rows):
            d = queries["dim"][0].as_py()
            turn = rotation(d)
            ids = rows["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            x = np.frombuffer(b"".join(rows["vector"].to_pylist()), np.float64).reshape(-1, d)[order]
            ids, unit = ids[order], _unit(x)
            turned = unit @ turn
            for query_id, data in zip(queries["vec_id"].to_pylist(), queries["vector"].to_pylist(), strict=True):
                query = _unit(np.frombuffer(data, np.float64))
                own = np.searchsorted(ids, [query_id, query_id + 1])
                # Its own row may take one of the k places.
                places, _ = adaptive_scan(query @ turn, turned, k + int(own[1] - own[0]))
                places = places[ids[places] != query_id]
                scores = np.einsum("ij,j->i", unit[places], query)
                for p in places[np.lexsort((ids[places], -scores))][:k]:
                    out[0].append(query_id)
                    out[1].append(int(ids[p]))
                    out[2].append(float(np.dot(unit[p], query)))
        return pa.table({
            "query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
            "score": pa.array(out[2], pa.float64())})
    return search


def fit(rows):
    """{vector length: centroids} from a bounded sample; lists grow with the rows up to LISTS."""
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "embedding").toArrow()
    found = {}
    for batch in sample.to_batches():
        for d, _, x in _by_length(*_vectors(batch)):
            found.setdefault(d, []).append(_unit(x))
    total = sum(len(x) for parts in found.values() for x in parts)
    return {
        d: centroids(np.concatenate(parts), min(LISTS, max(1, round(n / total * sum(map(len, parts)) / ROWS_PER_LIST))))
        for d, parts in found.items()}


def nearest(rows, queries, k=5, probes=PROBES, least_probes=LEAST_PROBES):
    """(query_id, rank, vec_id, score): the k rows of largest cosine found for each query; rows and
    queries: vec_id, embedding (array of float or double)."""
    rows, queries = rows.select("vec_id", "embedding"), queries.select("vec_id", "embedding")
    centres = fit(rows)
    listed = rows.mapInArrow(_assign(centres), _LISTED)
    sizes = listed.groupBy("dim", "list").agg(F.count("*").alias("n"))
    parts = sizes.select("dim", "list", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts"))  # a row per list
    listed = listed.join(F.broadcast(parts), ["dim", "list"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("parts")).cast("int"))
    asked = queries.mapInArrow(_probe(centres, probes, least_probes), _LISTED).join(F.broadcast(parts), ["dim", "list"])
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = (
        asked.drop("parts").groupBy("dim", "list", "part")
        .cogroup(listed.drop("parts").groupBy("dim", "list", "part")).applyInArrow(_search(k), _FOUND))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
