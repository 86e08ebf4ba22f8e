"""Rows met with the version of a type-2 history that was valid at their time."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .history import _met


def as_of_join(rows, history, key, time, columns, bucket="day"):
    """``rows`` with the ``columns``, valid_from and valid_to of their key's version at ``time``.

    A version is valid from valid_from until before valid_to, null for ever. Versions of a key do
    not overlap; of several that begin at one time the one with the greatest end counts, null being the greatest. Rows before a
    key's first version, in a gap, without key or without time keep nulls.

    Neither side is multiplied by the time it spans, and no task holds a whole key: rows and versions
    are laid under each other in (key, ``bucket`` of time), where each row takes the last version that began;
    what is valid when a bucket begins comes from one summary row per bucket.
    """
    both, taken = ["_key", "_bucket"], [*columns, "valid_from", "valid_to"]
    begins = F.date_trunc(bucket, "_at").cast("timestamp_ntz")
    known = history.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
    versions = known.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.struct(*taken).alias("_version"),
        F.struct(F.col("valid_to").isNull().alias("open"), F.col("valid_to").alias("end")).alias("_end"),
        F.lit(None).cast(rows.schema).alias("_row"))
    asked = rows.select(
        F.col(key).alias("_key"), F.col(time).cast("timestamp_ntz").alias("_at"),
        F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"),
        F.lit(None).cast(versions.schema["_end"].dataType).alias("_end"), F.struct(*rows.columns).alias("_row"))
    met = versions.unionByName(asked).withColumn("_bucket", begins)

    last = versions.withColumn("_bucket", begins).groupBy(*both).agg(
        F.max_by("_version", F.struct("_at", "_end")).alias("_last"))
    # Buckets that hold rows only must be in the list too, to be told what is valid when they begin.
    held = met.groupBy(*both).agg(F.max(F.lit(1)).alias("_any"))
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begun = _met(held, last, both, "left").select(
        *both, F.last("_last", ignorenulls=True).over(earlier).alias("_before"))

    upto = Window.partitionBy(*both).orderBy("_at", F.col("_row").isNotNull(), "_end").rowsBetween(
        Window.unboundedPreceding, 0)
    found = _met(met, begun, both).withColumn(
        "_valid", F.coalesce(F.last("_version", ignorenulls=True).over(upto), F.col("_before")))
    valid = F.col("_key").isNotNull() & (F.col("_valid.valid_to").isNull() | (F.col("_at") < F.col("_valid.valid_to")))
    return found.where(F.col("_row").isNotNull()).select(
        "_row.*", *[F.when(valid, F.col(f"_valid.{c}")).alias(c) for c in taken])
