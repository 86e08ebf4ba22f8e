"""Joins of many rows to a table with unique keys, safe against hot keys."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_FRACTION = 0.01
# A key above this share of the rows is split, each piece staying below the share.
# Shares add up to at most 1, so there are under 1 / HOT_SHARE such keys.
HOT_SHARE = 0.001


def _broadcast_limit(spark):
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    digits = text.rstrip("bkmgt")
    shift = next((units[c] for c in text[len(digits):] if c in units), 0)
    return int(digits) << shift if int(digits) > 0 else -1


def _text_bytes(table):
    lengths = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        for f in table.schema if isinstance(f.dataType, T.StringType)
    ]
    return F.coalesce(F.sum(sum(lengths, F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"))


def broadcastable(table):
    """The table, ready to be broadcast, or None where it is too large for that.

    Spark broadcasts by itself what it estimates to be under the session's threshold.
    Its estimate for a derived table may be far too high, so what exceeds it is
    measured: first the row count, which a written table answers from its footers.
    """
    limit = _broadcast_limit(table.sparkSession)
    if int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit:
        return table
    fixed = table.count() * 8 * (len(table.columns) + 1)
    if fixed > limit or fixed + table.agg(_text_bytes(table)).first()[0] > limit:
        return None
    return F.broadcast(table)


def hot_key_splits(rows, key):
    """``[(key, pieces)]`` for keys holding more than HOT_SHARE of the rows.

    Found on a sample of one column. Which keys are found only steers how the work
    is spread; the join result does not depend on it.
    """
    sample = rows.select(key).where(F.col(key).isNotNull()).sample(SAMPLE_FRACTION, seed=7)
    counts = sample.groupBy(key).agg(F.count("*").alias("_n"))
    share = F.col("_n") / sample.agg(F.count("*")).scalar()
    hot = counts.select(key, share.alias("_share")).where(F.col("_share") > HOT_SHARE)
    return [(k, int(s / HOT_SHARE) + 1) for k, s in hot.collect()]


def lookup_join(rows, lookup, key, spread_by, how="inner", sample_of=None):
    """Join ``rows`` to ``lookup`` (unique on ``key``) on the same-named column.

    A lookup under the session's broadcast threshold is broadcast and the rows stay
    where they are. A larger one is shuffled; the rows of a hot key are then dealt
    over several pieces by a hash of the ``spread_by`` columns and only that key's
    lookup row is repeated, once per piece (2 / HOT_SHARE rows in all at most).
    Rows with an unknown key are dealt out the same way. In a chain of joins the rows
    it starts from are passed as ``sample_of``, so that looking for hot keys does not
    run the earlier joins. Without hot keys an inner or semi join is a plain one, which shuffles
    nothing again where the rows already lie by the key.
    """
    small = broadcastable(lookup)
    if small is not None:
        return rows.join(small, key, how)

    spark = rows.sparkSession
    hot = hot_key_splits(rows if sample_of is None else sample_of, key)
    if not hot and how in ("inner", "left_semi"):
        return rows.join(lookup, key, how)
    key_type = rows.schema[key].dataType.simpleString()
    splits = F.broadcast(spark.createDataFrame(hot, f"{key} {key_type}, _pieces int"))
    many = F.lit(int(1 / HOT_SHARE))
    pieces = F.when(F.col(key).isNull(), many).otherwise(F.coalesce(F.col("_pieces"), F.lit(1)))
    dealt = rows.join(splits, key, "left").withColumn(
        "_piece", F.pmod(F.xxhash64(*spread_by), pieces).cast("int")
    )
    copies = lookup.join(splits, key, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    )
    joined = dealt.drop("_pieces").join(copies.drop("_pieces"), [key, "_piece"], how)
    return joined.drop("_piece")


def _present(table, table_key, column):
    return table.select(F.col(table_key).alias(column))


def integrity_valid(rows, references, spread_by):
    """Rows whose every reference exists; ``references`` = [(column, table, key)].

    Only existence matters, so these are semi joins: no table column travels and a
    repeated table key cannot multiply rows.
    """
    first = rows
    for column, table, table_key in references:
        known = _present(table, table_key, column)
        rows = lookup_join(rows, known, column, spread_by, "left_semi", first)
    return rows


def integrity_tagged(rows, references, spread_by):
    """All rows, with the names of the columns that point nowhere: one chain of joins tells the valid
    rows from the others."""
    first, columns = rows, rows.columns
    missing = []
    for column, table, table_key in references:
        flag = f"_has_{column}"
        known = _present(table, table_key, column).distinct().withColumn(flag, F.lit(True))
        rows = lookup_join(rows, known, column, spread_by, "left", first)
        missing.append(F.when(F.col(flag).isNull(), F.lit(column)))
    dangling = F.array_compact(F.array(*missing))
    return rows.select(*columns, dangling.alias("missing_references"))


def integrity_quarantine(rows, references, spread_by):
    """The rows that are not valid, with the names of the dangling columns."""
    return integrity_tagged(rows, references, spread_by).where(F.size("missing_references") > 0)


def new_keys(candidates, existing, key):
    """Distinct candidate keys that ``existing`` does not hold."""
    return candidates.select(key).distinct().join(existing.select(key), key, "left_anti")
