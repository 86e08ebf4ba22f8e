"""Half-open date windows over source tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import leading_date_or_null
from .profile import row_counts

# The column that dates a row of each source table.
WINDOW_COLUMNS = {
    "users": "update_at",
    "vehicles": "last_update_timestamp",
    "transactions": "rental_end_time",
}


def _dated(rows, column):
    data_type = rows.schema[column].dataType
    if isinstance(data_type, T.StringType):
        return leading_date_or_null(F.col(column)), T.DateType()
    return F.col(column), data_type


def undated(rows, column):
    """Rows that no window ever picks up."""
    return rows.where(_dated(rows, column)[0].isNull())


def window_filter(rows, column, start, end):
    """Rows dated in ``[start, end)``; rows without a date are left out.

    A date or datetime column is compared bare, which reaches the source as a
    pushed filter. Text that starts with ``dd-MM-yyyy`` is parsed first; other
    text has no date.
    """
    value, data_type = _dated(rows, column)
    low, high = (F.lit(str(d)).cast("date").cast(data_type) for d in (start, end))
    return rows.where((value >= low) & (value < high))


def pending_counts(tables, start, end):
    """Rows per source table that the next run will pick up."""
    return row_counts({
        name: window_filter(rows, WINDOW_COLUMNS[name], start, end)
        for name, rows in tables.items()
    })
