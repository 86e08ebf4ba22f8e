"""Incremental operators: high-water mark, keyed merge, keyed update."""

from pyspark.sql import functions as F

from .joins import lookup_join


def above_mark(batch, state, column):
    """Batch rows strictly above the greatest value held by the state.

    A state that is absent or has no value yet sets no mark: comparing with NULL
    would drop every row of this and all later batches.
    """
    if state is None:
        return batch
    mark = state.agg(F.max(column)).scalar()
    return batch.where(mark.isNull() | (F.col(column) > mark))


def merge_upsert(state, batch, keys):
    """Replace the state's rows that share a key with the batch, add the rest.

    The batch holds each key once. Whole rows are replaced, columns by name.
    """
    if state is None:
        return batch
    kept = state.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch)


def keyed_update(rows, updates, key, columns):
    """Set ``columns`` from ``updates`` (one row per key) where the key matches.

    Unmatched update keys are ignored; a NULL in an update is written as NULL.
    """
    fresh = updates.select(
        key, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    joined = lookup_join(rows, fresh, key, rows.columns, "left")
    return joined.select(*[
        F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c)
        for c in rows.columns
    ])
