"""JDBC source and sink."""

import datetime as dt

BATCH_ROWS = 5000


def day_slices(column, start, end):
    """One half-open predicate per day of ``[start, end)``, for parallel reads."""
    days = [start + dt.timedelta(days=i) for i in range((end - start).days)]
    return [
        f"{column} >= '{day}' AND {column} < '{day + dt.timedelta(days=1)}'" for day in days
    ]


def read_jdbc(spark, url, table, properties=None, slices=None):
    """A database table; with ``slices`` one read task per predicate.

    Without slices the table is one task, fit for small tables. Plain comparisons
    filtered on top of either form are pushed into the database.
    """
    properties = properties or {}
    if slices:
        return spark.read.jdbc(url, table, predicates=slices, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def append_jdbc(rows, url, table, properties=None, batch_rows=BATCH_ROWS):
    """Append rows; every task sends batches of ``batch_rows``."""
    rows.write.option("batchsize", batch_rows).jdbc(
        url, table, mode="append", properties=properties or {}
    )
