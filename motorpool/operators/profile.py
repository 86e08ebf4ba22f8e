"""Profiling: counts, nulls, duplicates, frequencies."""

from functools import reduce

from pyspark.sql import functions as F


def row_counts(tables):
    """``(table_name, row_count)`` for ``{name: rows}``."""
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _per_column(rows, measure, value_name):
    measured = rows.agg(*[measure(c).alias(c) for c in rows.columns])
    return measured.unpivot([], rows.columns, "column_name", value_name)


def null_counts(rows):
    return _per_column(rows, lambda c: F.count_if(F.col(c).isNull()), "null_count")


def column_summary(rows):
    """Name, position, type and number of known values of every column."""
    shape = rows.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(rows.schema)],
        "position int, column_name string, data_type string",
    )
    known = _per_column(rows, F.count, "non_null_count")
    return shape.join(known, "column_name")


def duplicate_count(rows, keys=None):
    """Rows beyond the first of each key; of each whole row without keys."""
    groups = rows.groupBy(*(keys or rows.columns)).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"))


def value_counts(rows, column):
    """Known values by falling frequency."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), column)


def peek(rows, n, order):
    return rows.orderBy(*order).limit(n)
