"""Type-2 history: versions of a row with the time they were valid."""

from pyspark.sql import Window
from pyspark.sql import functions as F

HISTORY_COLUMNS = ["scd_id", "scd_updated_at", "valid_from", "valid_to"]
# A day of one key with more changes is cut, into so many pieces at most.
MOST = 100_000
PIECES = 200


def _ntz(value):
    return F.lit(str(value)).cast("timestamp_ntz")


def _opened(rows, key, seen_at):
    stamp = _ntz(seen_at)
    return rows.select(
        "*",
        F.md5(F.concat_ws("|", F.col(key).cast("string"), stamp.cast("string"))).alias("scd_id"),
        stamp.alias("scd_updated_at"),
        stamp.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def scd2_step(history, batch, key, check_columns, seen_at):
    """Next history after seeing ``batch`` (one row per key) at ``seen_at``.

    A new key opens a version. A key whose watched columns differ, NULLs counting as
    equal, closes its open version and opens another. An unchanged key and a key that
    the batch lacks stay as they are. Columns are compared one by one: a row hash may
    collide, for one between (1, NULL) and (NULL, 1).

    The batch is the side that is broadcast when it is small, so a daily delta does
    not shuffle the open versions. The batch is used three times: store it first.
    """
    if history is None:
        return _opened(batch, key, seen_at)

    columns = batch.columns
    closed = history.where(F.col("valid_to").isNotNull())
    live = history.where(F.col("valid_to").isNull())

    incoming = batch.select(key, F.struct(*columns).alias("_new"))
    paired = live.join(incoming, key, "left")
    same = F.lit(True)
    for c in check_columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_new.{c}"))
    changed = F.col("_new").isNotNull() & ~same

    stamp = _ntz(seen_at)
    none = F.lit(None).cast("timestamp_ntz")
    new_id = F.md5(F.concat_ws("|", F.col(key).cast("string"), stamp.cast("string")))
    old = F.struct(
        *columns, "scd_id", "scd_updated_at", "valid_from",
        F.when(changed, stamp).alias("valid_to"),
    )
    new = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in columns], new_id.alias("scd_id"),
        stamp.alias("scd_updated_at"), stamp.alias("valid_from"), none.alias("valid_to"),
    )
    stepped = paired.select(
        F.inline(F.when(changed, F.array(old, new)).otherwise(F.array(old)))
    )

    known = live.select(key).join(batch.select(key), key, "left_semi")
    first_seen = _opened(batch.join(known, key, "left_anti"), key, seen_at)
    return closed.select(*stepped.columns).unionByName(stepped).unionByName(first_seen)


def current_versions(history):
    return history.where(F.col("valid_to").isNull())


def _met(rows, summary, keys, how="inner"):
    """Join in which NULL keys are equal."""
    there = summary.withColumnsRenamed({k: f"_at_{k}" for k in keys})
    meet = F.lit(True)
    for k in keys:
        meet = meet & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    return rows.join(there, meet, how).drop(*[f"_at_{k}" for k in keys])


def _cut(rows, key, time, most):
    """rows with ``_piece``: 0, or the place among the cuts of a (key, bucket) of more than ``most`` rows.

    Cuts are approximate quantiles of the time, PIECES at most. Equal times share a piece, so a piece is a
    span of time within its bucket. Which cuts are found only steers how the work is spread.
    """
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    rows = rows.withColumn("_at", F.timestamp_diff("MICROSECOND", epoch, F.col(time).cast("timestamp_ntz")))
    sizes = rows.groupBy(key, "_bucket").agg(F.count("*").alias("_n")).where(F.col("_n") > most).drop("_n")
    shares = [i / PIECES for i in range(1, PIECES)]
    cuts = _met(rows.select(key, "_bucket", "_at"), sizes, [key, "_bucket"]).groupBy(key, "_bucket").agg(
        F.array_distinct(F.percentile_approx("_at", shares, 100 * PIECES)).alias("_cuts"))
    # Left to the planner: nearly always a handful of rows, at most one for each ``most`` changes.
    dealt = _met(rows, cuts, [key, "_bucket"], "left")
    passed = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<bigint>")), lambda c: c <= F.col("_at")))
    return dealt.withColumn("_piece", passed).drop("_at", "_cuts")


def history_from_changes(changes, key, order, check_columns, bucket=None, most=MOST):
    """Whole history at once from a change log ordered by ``order`` within a key.

    Runs of equal watched values make one version, valid from its first change until
    the next version begins. ``order[0]`` is the change time, a date or datetime; ``order`` is unique per key.
    Changes without a key are those of one unknown key; changes without a time come
    first, with an unknown beginning.

    A key may hold a large part of the log, so no window spans a key: rows are compared
    within (key, bucket), by default the calendar day, and a bucket of more than ``most`` rows is
    cut into pieces of time. The neighbouring value across a border comes from one summary
    row per piece. Only changes of one key at one instant stay together.
    """
    time = order[0]
    rows = _cut(changes.select(
        key, *order, *check_columns,
        F.struct(*check_columns).alias("_state"),
        (F.col(time).cast("date") if bucket is None else bucket).alias("_bucket"),
    ), key, time, most)
    at = [key, "_bucket", "_piece"]
    piece = Window.partitionBy(*at).orderBy(*order)
    pieces = Window.partitionBy(key).orderBy("_bucket", "_piece")

    ends = rows.groupBy(*at).agg(F.max_by("_state", F.struct(*order)).alias("_end"))
    before = ends.select(*at, F.lag("_end").over(pieces).alias("_before"))
    previous = F.coalesce(F.lag("_state").over(piece), F.col("_before"))
    starts = (
        _met(rows, before, at)
        .withColumn("_previous", previous)
        .where(F.col("_previous").isNull() | ~F.col("_previous").eqNullSafe(F.col("_state")))
        .drop("_previous", "_before", "_state")
    )

    heads = starts.groupBy(*at).agg(F.min(time).alias("_head"))
    after = heads.select(*at, F.lead("_head").over(pieces).alias("_after"))
    until = F.coalesce(F.lead(time).over(piece), F.col("_after"))
    return _met(starts, after, at).select(
        key, *check_columns, F.col(time).alias("valid_from"), until.alias("valid_to")
    )
