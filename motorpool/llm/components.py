"""Connected components of an edge table, without gathering any of them."""

import pyarrow as pa
from pyspark.sql import functions as F

from .shared import pieces, saved


def _forest(batches):
    """Union-find over one partition's edges: each node once, with its least partner here."""
    parent = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    limit, schema = 500_000, pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def out():
        nodes = list(parent)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], schema=schema)

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > limit:  # bounded memory: what is known so far goes out
            yield out()
            parent.clear()
    yield out()


#: Edges of a task between two shuffles: rounds over few edges don't leave files of a few bytes each.
#: So many edges (some 10 MB) are also done by one union-find; beyond that no task sees them all.
_TASK_EDGES = 100_000

#: Rows of two numbers that are sent to all tasks (some 15 MB): larger tables are met in a shuffle.
ROWS_SENT = 500_000


def sent_whole(table, most=ROWS_SENT):
    """A stored table, by default of two numbers a row, sent to all tasks where it is small: what it joins stays where it lies."""
    return F.broadcast(table) if table.count() <= most else table


def _least(edges, tasks):
    """Each edge (u, v) with the least of u and all its partners. Partners of a hub are combined
    before the shuffle, and the join on u is one that AQE splits."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return edges.join(least, "u").coalesce(tasks)


def components(edges):
    """(u, v) bigint edges -> (node, component): component is the least node reachable.

    Union-find inside partitions, then rounds of large-star and small-star (each node's larger,
    then smaller partners move to its least partner) until nothing moves; nodes without an edge are
    not listed, self-edges and repeats are harmless. No component is ever in one place as a whole.
    """
    forest = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    forest, edges, state = saved(forest), None, None
    tasks = pieces(forest.count(), _TASK_EDGES)
    if tasks > 1:
        edges = saved(forest.mapInArrow(_forest, "u bigint, v bigint").where("u != v").distinct())
        tasks = pieces(edges.count(), _TASK_EDGES)
    if tasks == 1:
        few = forest if edges is None else edges
        edges = saved(few.coalesce(1).mapInArrow(_forest, "u bigint, v bigint").where("u != v"))
    while tasks > 1:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both, tasks).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large, tasks)
        edges = saved(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u != v").distinct().coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.distinct().coalesce(tasks))


def joined(groups, links):
    """The components (node, component) after links (u, v) were added. Only the links between
    different components are worked on, as edges between their least nodes."""
    ends, known = links, sent_whole(groups)
    for end in ("u", "v"):
        named = known.select(F.col("node").alias(end), F.col("component").alias(f"{end}_least"))
        ends = ends.join(named, end, "left")
    between = ends.select(F.coalesce("u_least", "u").alias("u"), F.coalesce("v_least", "v").alias("v"))
    moved = saved(components(between))
    few = sent_whole(moved)
    moves = few.select(F.col("node").alias("component"), F.col("component").alias("least"))
    kept = groups.join(moves, "component", "left").select("node", F.coalesce("least", "component").alias("component"))
    return saved(kept.unionByName(moved.join(known, "node", "left_anti")))
