"""Keep the latest row of every key."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def dedup_latest(rows, keys, latest):
    """One row per key: the greatest ``latest`` columns, NULLs losing.

    Equal candidates are told apart by the remaining columns, so the survivor does
    not depend on the order of the input. Filtering ``row_number`` to 1 lets Spark
    cut every map partition to one row per key before the shuffle, so a key that
    holds much of the input reaches its reducer as a handful of rows.
    """
    rest = [c for c in rows.columns if c not in keys and c not in latest]
    order = [F.col(c).desc_nulls_last() for c in latest]
    order += [F.col(c).asc_nulls_last() for c in rest]
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")
