"""Date and datetime expressions. All datetimes are TIMESTAMP_NTZ."""

import datetime as dt

from pyspark.sql import functions as F

BUSINESS_ZONE = "Asia/Jakarta"
BUSINESS_OFFSET = dt.timedelta(hours=7)  # the zone has no daylight saving
DATE_TEXT = "dd-MM-yyyy"
DATETIME_TEXT = "dd-MM-yyyy HH:mm:ss"


def _as_col(value):
    return F.lit(value) if isinstance(value, (dt.date, str)) else value


def date_from_text(col):
    """Strict ``dd-MM-yyyy``; other text raises, as in the warehouse."""
    return F.to_date(col, DATE_TEXT)


def leading_date_from_text(col):
    """Date at the start of the text; a trailing time of day is ignored."""
    return F.to_date(F.left(col, F.lit(10)), DATE_TEXT)


def leading_date_or_null(col):
    """The same where text without a date may occur: NULL for it."""
    return F.try_to_date(F.left(col, F.lit(10)), DATE_TEXT)


def datetime_from_text(col):
    return F.to_timestamp_ntz(col, F.lit(DATETIME_TEXT))


def datetime_text(col):
    return F.date_format(col, DATETIME_TEXT)


def nanos_to_datetime(col):
    """Epoch nanoseconds to datetime, rounded to the nearest microsecond.

    The division is done in double and halves round away from zero. Adding to an
    NTZ epoch keeps the session time zone out of it.
    """
    micros = F.round(col.cast("double") / F.lit(1000.0)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def calendar_date(col):
    return col.cast("date")


def days_between(later, earlier):
    """Midnights crossed, not 24-hour units: 23:59 to 00:01 is one day."""
    return F.datediff(_as_col(later), _as_col(earlier)).cast("bigint")


def years_between(later, earlier):
    """New Years crossed: 31 December to 1 January is one year."""
    return (F.year(_as_col(later)) - F.year(_as_col(earlier))).cast("bigint")


def calendar_parts(col):
    """Year, month, day and day of week (1 = Sunday) by name."""
    return {
        "rental_year": F.year(col).cast("bigint"),
        "rental_month": F.month(col).cast("bigint"),
        "rental_day": F.dayofmonth(col).cast("bigint"),
        "rental_dayofweek": F.dayofweek(col).cast("bigint"),
    }


def is_weekend(col):
    """Sunday or Saturday; FALSE for an unknown date."""
    return F.when(F.dayofweek(col).isin(1, 7), F.lit(True)).otherwise(F.lit(False))


def business_date(utc_datetime):
    """Calendar date in the business zone of a UTC datetime column."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(BUSINESS_ZONE), utc_datetime)
    return local.cast("date")


def business_today(now_utc):
    """The same for one Python datetime, used to name windows and extracts."""
    return (now_utc + BUSINESS_OFFSET).date()
