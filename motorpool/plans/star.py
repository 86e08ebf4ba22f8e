"""Dimensions, fact and the wide view."""

from pyspark.sql import functions as F

from ..functions import (
    ACCOUNT_AGE_BANDS, VEHICLE_AGE_BANDS, band, calendar_parts, days_between, is_weekend,
    join_non_null, years_between,
)
from ..operators import (
    above_mark, current_versions, integrity_quarantine, integrity_tagged, integrity_valid,
    lookup_join,
)
from ..operators.joins import broadcastable


def dim_users(history, as_of=None):
    """Current users; ages count up to ``as_of``, today by default."""
    as_of = F.current_date() if as_of is None else F.lit(as_of)
    return current_versions(history).select(
        "user_id", "first_name", "last_name",
        join_non_null(" ", F.col("first_name"), F.col("last_name")).alias("full_name"),
        "email", "phone_number", "driver_license_number", "driver_license_expiry",
        "creation_date",
        days_between(as_of, F.col("creation_date")).alias("age_account"),
        "is_active", "update_at",
    ).withColumn("age_account_segment", band(F.col("age_account"), ACCOUNT_AGE_BANDS))


def dim_vehicles(history, as_of=None):
    as_of = F.current_date() if as_of is None else F.lit(as_of)
    return current_versions(history).select(
        "vehicle_id", "active", "vehicle_license_number", "registration_name",
        "license_type", "expiration_date", "permit_license_number", "certification_date",
        "vehicle_year", "base_telephone_number", "base_address", "last_update_timestamp",
        "brand", "vehicle_type",
        years_between(as_of, F.col("certification_date")).alias("age_vehicle"),
    ).withColumn("age_vehicle_segment", band(F.col("age_vehicle"), VEHICLE_AGE_BANDS))


def dim_locations(enriched):
    return enriched.select(
        "location_id", "location_name", "address", "city", "state", "zip_code",
        "latitude", "longitude",
    )


def references(users, vehicles, locations):
    """What every rental must point to. The small table goes first: it costs no shuffle."""
    return [
        ("pickup_location", locations, "location_id"),
        ("dropoff_location", locations, "location_id"),
        ("vehicle_id", vehicles, "vehicle_id"),
        ("user_id", users, "user_id"),
    ]


def fact_transactions(rentals, users, vehicles, locations, state=None):
    """The batch of rentals to merge into the fact: above its mark, references intact."""
    fresh = above_mark(rentals, state, "rental_end_time")
    return fact_columns(integrity_valid(fresh, references(users, vehicles, locations), ["rental_id"]))


def fact_columns(valid):
    return valid.select(
        "rental_id", "user_id", "vehicle_id", "rental_start_time", "rental_end_time",
        days_between(F.col("rental_end_time"), F.col("rental_start_time"))
        .alias("rental_duration_days"),
        "pickup_location", "dropoff_location", "total_amount",
    )


def fact_quarantine(rentals, users, vehicles, locations):
    """Rentals that the fact leaves out, with the references they miss."""
    return integrity_quarantine(rentals, references(users, vehicles, locations), ["rental_id"])


def judged_rentals(rentals, users, vehicles, locations):
    """All rentals with the references they miss, comma-joined, and their ``outcome``: fact or left_out."""
    tagged = integrity_tagged(rentals, references(users, vehicles, locations), ["rental_id"])
    outcome = F.when(F.size("missing_references") == 0, "fact").otherwise("left_out")
    return tagged.select(
        *rentals.columns, F.array_join("missing_references", ",").alias("missing_references"), outcome.alias("outcome"))


LOCATION_COLUMNS = ["location_name", "address", "city", "state", "zip_code", "latitude", "longitude"]


def at_location(rows, locations, role, columns, fact):
    """Inner join to the ``role`` (pickup, dropoff) location, columns prefixed by the role.

    The seed is the one dimension that can lose rows, so readers of the fact join it
    again; users and vehicles only ever gain keys.
    """
    named = {
        c: f"{role}_location_name" if c == "location_name" else f"{role}_{c}" for c in columns
    }
    lookup = locations.select(
        F.col("location_id").alias(f"{role}_location"),
        *[F.col(c).alias(name) for c, name in named.items()],
    )
    return lookup_join(rows, lookup, f"{role}_location", ["rental_id"], sample_of=fact)


def denormalized_transactions(fact, users, vehicles, locations, sample_of=None, stored=None):
    """One wide row per rental: both locations, the vehicle and the user.

    Users and vehicles may have to be met by a shuffle, so they come first, while the rows are narrow.
    Users lead: the fact's last check left its rows by user, and a user has fewer columns than a vehicle.
    Hot keys are looked for in ``sample_of``, the fact by default: stored rows for a fact that is not.
    ``stored`` may write and read again the rows that have met their users, if those have to be shuffled
    once more: what was shuffled before can go then, while they and their vehicles are.
    """
    sample_of = fact if sample_of is None else sample_of
    vehicle_columns = vehicles.withColumnsRenamed({
        "last_update_timestamp": "vehicle_last_update_timestamp", "brand": "vehicle_brand",
    })
    wide = lookup_join(fact, users, "user_id", ["rental_id"], sample_of=sample_of)
    if stored is not None and broadcastable(vehicle_columns) is None:
        wide = stored(wide)
    wide = lookup_join(wide, vehicle_columns, "vehicle_id", ["rental_id"], sample_of=sample_of)
    wide = at_location(wide, locations, "pickup", LOCATION_COLUMNS, sample_of)
    wide = at_location(wide, locations, "dropoff", LOCATION_COLUMNS, sample_of)
    end = F.col("rental_end_time")
    return wide.select(
        "rental_id",
        "user_id", "first_name", "last_name", "full_name", "email", "phone_number",
        "driver_license_number", "driver_license_expiry", "creation_date", "age_account",
        "age_account_segment", "is_active", "update_at",
        "vehicle_id", "active", "vehicle_license_number", "registration_name", "license_type",
        "expiration_date", "permit_license_number", "certification_date", "vehicle_year",
        "base_telephone_number", "base_address", "vehicle_last_update_timestamp",
        "vehicle_brand", "vehicle_type", "age_vehicle", "age_vehicle_segment",
        "rental_start_time", "rental_end_time", "rental_duration_days",
        *[part.alias(name) for name, part in calendar_parts(end).items()],
        is_weekend(end).alias("is_weekend"),
        F.col("pickup_location").alias("pickup_location_id"),
        *_role_columns("pickup"),
        F.col("dropoff_location").alias("dropoff_location_id"),
        *_role_columns("dropoff"),
        "total_amount",
    )


def _role_columns(role):
    return [f"{role}_{c}" for c in LOCATION_COLUMNS]
