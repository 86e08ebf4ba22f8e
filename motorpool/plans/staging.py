"""Staging models: typed, cleaned, one row per key."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_text, date_from_text, datetime_from_text, nanos_to_datetime
from ..operators import above_mark, dedup_latest

LOCATION_TEXT = ["location_name", "address", "city", "state"]


def clean_locations(locations):
    """Location file with its text columns normalised, ready to be the seed."""
    return locations.withColumns({c: clean_text(F.col(c)) for c in LOCATION_TEXT})


def location_enrichment(seed):
    return seed.select(
        F.col("location_id").cast("string").alias("location_id"),
        "location_name", "address", "city", "state",
        F.col("zip_code").cast("string").alias("zip_code"),
        "latitude", "longitude",
    )


def clean_users(raw):
    users = raw.where(F.col("user_id").isNotNull()).select(
        "user_id",
        clean_text(F.col("first_name")).alias("first_name"),
        clean_text(F.col("last_name")).alias("last_name"),
        "email", "phone_number", "driver_license_number", "driver_license_expiry",
        "creation_date",
        F.col("is_active").cast("boolean").alias("is_active"),
        "update_at",
    )
    return dedup_latest(users, ["user_id"], ["creation_date", "update_at"])


def casted_vehicles(raw):
    return raw.select(
        "vehicle_id",
        F.col("active").cast("boolean").alias("active"),
        F.col("vehicle_license_number").cast("string").alias("vehicle_license_number"),
        "registration_name", "license_type",
        date_from_text(F.col("expiration_date")).alias("expiration_date"),
        "permit_license_number", "certification_date", "vehicle_year",
        "base_telephone_number", "base_address",
        datetime_from_text(F.col("last_update_timestamp")).alias("last_update_timestamp"),
        "brand", "vehicle_type",
    )


def clean_vehicles(casted):
    known = casted.where(F.col("vehicle_id").isNotNull())
    return dedup_latest(known, ["vehicle_id"], ["last_update_timestamp"])


def _datetime(rows, column):
    """Raw extracts carry datetimes, or epoch nanoseconds as BIGINT."""
    if isinstance(rows.schema[column].dataType, T.LongType):
        return nanos_to_datetime(F.col(column))
    return F.col(column).cast("timestamp_ntz")


def keyed_transactions(raw):
    return raw.where(F.col("rental_id").isNotNull()).select(
        "rental_id", "user_id", "vehicle_id",
        _datetime(raw, "rental_start_time").alias("rental_start_time"),
        _datetime(raw, "rental_end_time").alias("rental_end_time"),
        "pickup_location", "dropoff_location", "total_amount",
    )


def clean_transactions(raw, state=None):
    """The batch of rentals to merge: above the mark of ``state``, one row per rental.

    The mark comes first, so duplicates are settled within the batch; the merge
    settles those across batches in favour of the later one.
    """
    fresh = above_mark(keyed_transactions(raw), state, "rental_end_time")
    return dedup_latest(fresh, ["rental_id"], ["rental_end_time", "rental_start_time"])
