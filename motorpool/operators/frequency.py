"""Most frequent values per key, and top rows per group."""

from functools import reduce

from pyspark.sql import functions as F


def mode_by(rows, key, attributes, weight=None):
    """Per key, the most frequent value of each ``{output: input}`` attribute.

    Ties go to the lowest value in the order of its own type, NULL counting as a value
    and coming last. A row counts once, or as often as its ``weight`` column says. Each
    attribute is counted by itself and the best pair of (count, value) is taken by an aggregate, so a
    task holds the counts of one attribute only; the results, one row a key, are laid under each
    other. Both steps combine before their shuffle, so neither a hot key nor a hot value
    gathers in one task. The rows are read once per attribute: store them first if they are dear.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    value = F.col("_value")

    def candidates(out, column):
        counted = rows.groupBy(key, F.col(column).alias("_value")).agg(F.sum(times).alias("_n"))
        candidate = F.struct((-F.col("_n")).alias("rank"), value.isNull().alias("unknown"), value.alias("value"))
        return counted.groupBy(key).agg(F.min(candidate).alias(out))

    every = reduce(
        lambda above, below: above.unionByName(below, allowMissingColumns=True),
        [candidates(out, column) for out, column in attributes.items()])
    return every.groupBy(key).agg(*[F.min(out)["value"].alias(out) for out in attributes])


def top_per_group(rows, group, key, count_name):
    """Every key that reaches the highest row count of its group, ties included.

    The same rows as ``rank() = 1`` by descending count. The highest count per group
    is joined back instead of ranking, so the keys of one group never meet in one
    task. ``group`` is a DATE: its domain bounds the broadcast side.
    """
    counts = rows.groupBy(group, key).agg(F.count("*").alias(count_name))
    best = counts.groupBy(group).agg(F.max(count_name).alias("_best"))
    return (
        counts.join(F.broadcast(best), group)
        .where(F.col(count_name) == F.col("_best"))
        .drop("_best")
    )
