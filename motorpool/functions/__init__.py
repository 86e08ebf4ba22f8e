from .bands import ACCOUNT_AGE_BANDS, VEHICLE_AGE_BANDS, band
from .dates import (
    business_date, business_today, calendar_date, calendar_parts, date_from_text,
    datetime_from_text, datetime_text, days_between, is_weekend, leading_date_from_text,
    nanos_to_datetime, years_between,
)
from .money import money_average, money_merged, money_parts, money_total, money_value
from .text import clean_text, join_non_null

__all__ = [
    "ACCOUNT_AGE_BANDS", "VEHICLE_AGE_BANDS", "band", "business_date", "business_today",
    "calendar_date", "calendar_parts", "clean_text", "date_from_text", "datetime_from_text",
    "datetime_text", "days_between", "is_weekend", "join_non_null",
    "leading_date_from_text", "money_average", "money_merged", "money_parts", "money_total",
    "money_value", "nanos_to_datetime",
    "years_between",
]
