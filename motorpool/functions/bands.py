"""Banding of ages into named segments."""

from pyspark.sql import functions as F

# Inclusive upper bounds; beyond the last, or unknown, is 'Old'.
ACCOUNT_AGE_BANDS = [(30, "New"), (180, "Medium")]
VEHICLE_AGE_BANDS = [(2, "New"), (5, "Medium")]


def band(col, bounds, default="Old"):
    (first, label), *rest = bounds
    expr = F.when(col <= first, F.lit(label))
    for upper, name in rest:
        expr = expr.when(col <= upper, F.lit(name))
    return expr.otherwise(F.lit(default))
