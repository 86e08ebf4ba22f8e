"""Entity schemas, layer names and the fixed column lists of the history tables.

Nothing is NOT NULL and no key is declared: duplicates, nulls and dangling keys
are expected input and handled by the staging models.
"""

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("driver_license_number", T.StringType()),
    T.StructField("driver_license_expiry", T.DateType()),
    T.StructField("creation_date", T.DateType()),
    T.StructField("is_active", T.IntegerType()),
    T.StructField("update_at", T.DateType()),
])

VEHICLES = T.StructType([
    T.StructField("active", T.IntegerType()),
    T.StructField("vehicle_license_number", T.StringType()),
    T.StructField("registration_name", T.StringType()),
    T.StructField("license_type", T.StringType()),
    T.StructField("expiration_date", T.StringType()),
    T.StructField("permit_license_number", T.StringType()),
    T.StructField("certification_date", T.DateType()),
    T.StructField("vehicle_year", T.IntegerType()),
    T.StructField("base_telephone_number", T.StringType()),
    T.StructField("base_address", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("last_update_timestamp", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("rental_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("rental_start_time", T.TimestampNTZType()),
    T.StructField("rental_end_time", T.TimestampNTZType()),
    T.StructField("pickup_location", T.StringType()),
    T.StructField("dropoff_location", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
])

# The seed file carries its ids as integers; staging casts them to text.
LOCATIONS = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip_code", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

SOURCE_SCHEMAS = {
    "users": USERS,
    "vehicles": VEHICLES,
    "transactions": TRANSACTIONS,
    "locations": LOCATIONS,
}

# One namespace per layer, and where each relation lives.
LAYERS = {
    "raw_users": "staging_dataset",
    "raw_vehicles": "staging_dataset",
    "raw_transactions": "staging_dataset",
    "clean_transactions": "staging_dataset",
    "location_enrichment": "seed_dataset",
    "snapshot_users": "snapshot_dataset",
    "snapshot_vehicles": "snapshot_dataset",
    "denormalized_transactions": "transform_dataset",
    "dim_users": "reporting_dataset",
    "dim_vehicles": "reporting_dataset",
    "dim_locations": "reporting_dataset",
    "fact_transactions": "reporting_dataset",
    "left_out_transactions": "reporting_dataset",
    "users_summary": "reporting_dataset",
    "vehicles_summary": "reporting_dataset",
    "daily_performance": "reporting_dataset",
    "daily_top_entities": "reporting_dataset",
    "daily_top_users": "reporting_dataset",
    "daily_top_vehicles": "reporting_dataset",
}

# The columns whose change opens a new version. creation_date of a
# user and certification_date, vehicle_year, brand of a vehicle are not watched.
USER_CHECK_COLUMNS = [
    "first_name", "last_name", "email", "phone_number", "driver_license_number",
    "driver_license_expiry", "is_active", "update_at",
]
VEHICLE_CHECK_COLUMNS = [
    "active", "vehicle_license_number", "registration_name", "license_type",
    "expiration_date", "permit_license_number", "base_telephone_number",
    "base_address", "last_update_timestamp", "vehicle_type",
]
