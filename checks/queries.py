"""One query per operator or model, over the whole of the driver's tables."""

import datetime as dt

from pyspark.sql import functions as F

from motorpool.functions import (
    business_date, is_weekend, nanos_to_datetime,
)
from motorpool.operators import (
    as_of_join, column_summary, duplicate_count, history_from_changes,
    keyed_update, merge_upsert, new_keys, null_counts, peek, pending_counts,
    row_counts, scd2_step, value_counts, window_filter,
)
from motorpool.plans import marts, staging, star
from motorpool.plans.daily import run_day, snapshot
from motorpool.schemas import USER_CHECK_COLUMNS, VEHICLE_CHECK_COLUMNS
from motorpool.session import shared_dir, shuffles_dropped
from motorpool.sources import Warehouse, land_extract, load_raw, read_csv, write_csv

from . import adapter

AS_OF = dt.date.fromisoformat(adapter.AS_OF)
FIRST_SEEN = dt.datetime(2001, 12, 31)
THEN_SEEN = dt.datetime(2002, 1, 1)
CUT = dt.date(2000, 1, 1)
WINDOW = (dt.date(1997, 1, 1), dt.date(1999, 7, 1))


# Stages shared by the queries; all lazy.

def _locations(spark, sf_dir):
    seed = staging.clean_locations(adapter.locations(spark, sf_dir))
    return star.dim_locations(staging.location_enrichment(seed))


def _users(spark, sf_dir):
    batch = staging.clean_users(adapter.users(spark, sf_dir))
    return star.dim_users(scd2_step(None, batch, "user_id", USER_CHECK_COLUMNS, THEN_SEEN), AS_OF)


def _vehicles(spark, sf_dir):
    batch = staging.clean_vehicles(staging.casted_vehicles(adapter.vehicles(spark, sf_dir)))
    history = scd2_step(None, batch, "vehicle_id", VEHICLE_CHECK_COLUMNS, THEN_SEEN)
    return star.dim_vehicles(history, AS_OF)


def _dimensions(spark, sf_dir):
    return _users(spark, sf_dir), _vehicles(spark, sf_dir), _locations(spark, sf_dir)


def _rentals(spark, sf_dir):
    return staging.clean_transactions(adapter.transactions(spark, sf_dir))


def _star(spark, sf_dir):
    dimensions = _dimensions(spark, sf_dir)
    return star.fact_transactions(_rentals(spark, sf_dir), *dimensions), *dimensions


def _written_star(spark, sf_dir):
    """The same with the fact as the stored table it is, for marts that read it more than once."""
    fact, *dimensions = _star(spark, sf_dir)
    path = shared_dir(spark, "fact")
    fact.write.parquet(path)
    return spark.read.schema(fact.schema).parquet(path), *dimensions


def _sources(spark, sf_dir):
    return {
        "users": adapter.users(spark, sf_dir),
        "vehicles": adapter.vehicles(spark, sf_dir),
        "transactions": adapter.transactions(spark, sf_dir),
    }


# Staging.

def clean_users(spark, sf_dir):
    return staging.clean_users(adapter.users(spark, sf_dir))


def casted_vehicles(spark, sf_dir):
    return staging.casted_vehicles(adapter.vehicles(spark, sf_dir))


def clean_vehicles(spark, sf_dir):
    return staging.clean_vehicles(casted_vehicles(spark, sf_dir))


def clean_locations(spark, sf_dir):
    return staging.clean_locations(adapter.locations(spark, sf_dir))


def location_enrichment(spark, sf_dir):
    return staging.location_enrichment(clean_locations(spark, sf_dir))


def epoch_nanos_to_datetime(spark, sf_dir):
    ends = adapter.transactions(spark, sf_dir).select("rental_id", "rental_end_time")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    nanos = F.timestamp_diff("MICROSECOND", epoch, F.col("rental_end_time")) * 1000
    raw = ends.select("rental_id", nanos.alias("rental_end_nanos"))
    return raw.withColumn("rental_end_time", nanos_to_datetime(F.col("rental_end_nanos")))


# Incremental rentals.

def _first_batch(spark, sf_dir):
    raw = adapter.transactions(spark, sf_dir)
    return staging.clean_transactions(raw.where(F.col("rental_end_time") <= F.lit(CUT)))


def clean_transactions_incremental(spark, sf_dir):
    """A first load up to the cut, then everything delivered again: late rows stay out."""
    state = _first_batch(spark, sf_dir)
    batch = staging.clean_transactions(adapter.transactions(spark, sf_dir), state)
    return merge_upsert(state, batch, ["rental_id"])


def fact_incremental(spark, sf_dir):
    dimensions = _dimensions(spark, sf_dir)
    state = star.fact_transactions(_first_batch(spark, sf_dir), *dimensions)
    clean = clean_transactions_incremental(spark, sf_dir)
    batch = star.fact_transactions(clean, *dimensions, state)
    return merge_upsert(state, batch, ["rental_id"])


def keyed_update_users(spark, sf_dir):
    """Active users of the longest membership are switched off, keys found elsewhere ignored."""
    rows = adapter.users(spark, sf_dir)
    due = rows.where((F.col("creation_date") < F.lit(dt.date(1996, 1, 1))) & (F.col("is_active") == 1))
    updates = due.select("user_id").distinct().unionByName(
        adapter.vehicles(spark, sf_dir).select(F.concat(F.lit("v"), "vehicle_id").alias("user_id"))
        .where(F.col("user_id").isNotNull()).distinct()
    ).select("user_id", F.lit(0).alias("is_active"), F.lit(AS_OF).alias("update_at"))
    return keyed_update(rows, updates, "user_id", ["is_active", "update_at"])


# Histories.

def _two_steps(batches, clean, key, columns):
    first, second = (clean(batch) for batch in batches)
    history = scd2_step(None, first, key, columns, FIRST_SEEN)
    return scd2_step(history, second, key, columns, THEN_SEEN)


def scd2_users_two_batches(spark, sf_dir):
    batches = adapter.user_batches(spark, sf_dir)
    return _two_steps(batches, staging.clean_users, "user_id", USER_CHECK_COLUMNS)


def scd2_vehicles_two_batches(spark, sf_dir):
    return _two_steps(
        adapter.vehicle_batches(spark, sf_dir),
        lambda raw: staging.clean_vehicles(staging.casted_vehicles(raw)),
        "vehicle_id", VEHICLE_CHECK_COLUMNS,
    )


def current_users_after_two_batches(spark, sf_dir):
    return star.dim_users(scd2_users_two_batches(spark, sf_dir), AS_OF)


def scd2_history_closed_form(spark, sf_dir):
    events = adapter.events(spark, sf_dir)
    return history_from_changes(events, "user_id", ["ts", "event_id"], ["event_type"])


# Star.

def dim_users(spark, sf_dir):
    return _users(spark, sf_dir)


def dim_vehicles(spark, sf_dir):
    return _vehicles(spark, sf_dir)


def dim_locations(spark, sf_dir):
    return _locations(spark, sf_dir)


def fact_transactions(spark, sf_dir):
    return _star(spark, sf_dir)[0]


def fact_quarantine(spark, sf_dir):
    dangling = star.fact_quarantine(_rentals(spark, sf_dir), *_dimensions(spark, sf_dir))
    return dangling.withColumn("missing_references", F.array_join("missing_references", ","))


def denormalized_transactions(spark, sf_dir):
    """From stored rentals: looking for hot keys reads them several times."""
    def kept(rows, purpose):
        path = shared_dir(spark, purpose)
        with shuffles_dropped(spark):
            rows.write.parquet(path, compression="zstd")
        return spark.read.schema(rows.schema).parquet(path)

    rentals, dimensions = kept(_rentals(spark, sf_dir), "rentals"), _dimensions(spark, sf_dir)
    fact = star.fact_transactions(rentals, *dimensions)
    return star.denormalized_transactions(
        fact, *dimensions, rentals, lambda rows: kept(rows, "rentals_of_users"))


def weekend_split(spark, sf_dir):
    fact = _star(spark, sf_dir)[0]
    return fact.groupBy(is_weekend(F.col("rental_end_time")).alias("is_weekend")).agg(
        F.count("*").alias("total_transactions")
    )


# Marts.

def user_favourites(spark, sf_dir):
    fact, _, vehicles, locations = _written_star(spark, sf_dir)
    return marts.user_favourites(fact, vehicles, locations)


def vehicle_favourites(spark, sf_dir):
    fact, _, _, locations = _written_star(spark, sf_dir)
    return marts.vehicle_favourites(fact, locations)


def users_summary(spark, sf_dir):
    return marts.users_summary(*_written_star(spark, sf_dir))


def vehicles_summary(spark, sf_dir):
    return marts.vehicles_summary(*_written_star(spark, sf_dir))


def daily_performance(spark, sf_dir):
    fact, _, _, locations = _written_star(spark, sf_dir)
    return marts.daily_performance(fact, locations)


def daily_top_users(spark, sf_dir):
    fact, users, _, locations = _star(spark, sf_dir)
    return marts.daily_top_users(fact, users, locations)


def daily_top_vehicles(spark, sf_dir):
    fact, _, vehicles, locations = _star(spark, sf_dir)
    return marts.daily_top_vehicles(fact, vehicles, locations)


def daily_top_entities(spark, sf_dir):
    return marts.daily_top_entities(*_written_star(spark, sf_dir))


# Windows.

def window_extract_users(spark, sf_dir):
    return window_filter(adapter.users(spark, sf_dir), "update_at", *WINDOW)


def window_extract_vehicles(spark, sf_dir):
    return window_filter(adapter.vehicles(spark, sf_dir), "last_update_timestamp", *WINDOW)


def window_extract_transactions(spark, sf_dir):
    return window_filter(adapter.transactions(spark, sf_dir), "rental_end_time", *WINDOW)


def pending_window_counts(spark, sf_dir):
    return pending_counts(_sources(spark, sf_dir), *WINDOW)


def business_dates(spark, sf_dir):
    events = adapter.events(spark, sf_dir)
    return events.groupBy(business_date(F.col("ts")).alias("business_date")).agg(
        F.count("*").alias("events")
    )


# Profiling.

def profile_row_counts(spark, sf_dir):
    return row_counts({**_sources(spark, sf_dir), "locations": adapter.locations(spark, sf_dir)})


def profile_columns(spark, sf_dir):
    return column_summary(adapter.users(spark, sf_dir))


def profile_null_counts(spark, sf_dir):
    return null_counts(adapter.vehicles(spark, sf_dir))


def profile_duplicate_keys(spark, sf_dir):
    return duplicate_count(adapter.transactions(spark, sf_dir), ["rental_id"])


def profile_duplicate_rows(spark, sf_dir):
    rows = adapter.transactions(spark, sf_dir)
    return duplicate_count(rows)


def profile_value_counts(spark, sf_dir):
    return value_counts(adapter.vehicles(spark, sf_dir), "brand")


def peek_latest_rentals(spark, sf_dir):
    order = [F.desc("rental_end_time"), F.asc("rental_id")]
    return peek(_rentals(spark, sf_dir), 3, order)


def dangling_new_ids(spark, sf_dir):
    """Ids of both deliveries that the first one lacks."""
    first, second = adapter.user_batches(spark, sf_dir)
    known = first.where(F.col("user_id").isNotNull())
    both = known.select("user_id").unionByName(
        second.select("user_id").where(F.col("user_id").isNotNull())
    )
    return new_keys(both, known, "user_id")


# Sources and sinks, through files in the shared folder.

def csv_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "csv") + "/transactions"
    write_csv(adapter.transactions(spark, sf_dir), path)
    return read_csv(spark, path, "transactions")


def parquet_extract_roundtrip(spark, sf_dir):
    rows = window_extract_transactions(spark, sf_dir)
    path = land_extract(rows, shared_dir(spark, "landing"), "transactions", "1999-06-30")
    return load_raw(spark, path)


DAYS = [dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1), dt.datetime(2002, 1, 1)]
FIRST_START = dt.date(1990, 1, 1)
_RUNS = {}


def _warehouse(spark):
    return Warehouse(spark, shared_dir(spark, "warehouse"), period="yyyy-MM", key_buckets=8)


def _daily_runs(spark, sf_dir):
    """Three daily runs, the last one repeated with an empty window; once per session and folder of tables."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _RUNS:
        warehouse = _warehouse(spark)
        seed = staging.clean_locations(adapter.locations(spark, sf_dir))
        sources = {**_sources(spark, sf_dir), "locations": seed}
        warehouse.start_date().set(FIRST_START, dt.datetime(1990, 1, 1))
        for now in [*DAYS, DAYS[-1]]:
            tables = run_day(warehouse, sources, now)
        _RUNS[key] = tables
    return _RUNS[key]


def run_day_fact(spark, sf_dir):
    """The fact after the daily runs."""
    return _daily_runs(spark, sf_dir)["fact_transactions"]


def run_day_quarantine(spark, sf_dir):
    """The rentals that the daily runs left out of the fact, as the last run stored them."""
    return _daily_runs(spark, sf_dir)["left_out_transactions"]


def run_day_dim_users(spark, sf_dir):
    return _daily_runs(spark, sf_dir)["dim_users"]


def run_day_dim_vehicles(spark, sf_dir):
    return _daily_runs(spark, sf_dir)["dim_vehicles"]


def run_day_users_summary(spark, sf_dir):
    """The marts as the daily runs brought them up to date, by the periods each run touched."""
    return _daily_runs(spark, sf_dir)["users_summary"]


def run_day_vehicles_summary(spark, sf_dir):
    return _daily_runs(spark, sf_dir)["vehicles_summary"]


def run_day_daily_performance(spark, sf_dir):
    return _daily_runs(spark, sf_dir)["daily_performance"]


def run_day_daily_top_entities(spark, sf_dir):
    return _daily_runs(spark, sf_dir)["daily_top_entities"]


def daily_user_history(spark, sf_dir):
    """The stored history of users after three daily windows."""
    warehouse, start = _warehouse(spark), FIRST_START
    for now in DAYS:
        window = window_filter(adapter.users(spark, sf_dir), "update_at", start, now.date())
        history = snapshot(
            warehouse, "snapshot_users", staging.clean_users(window), "user_id",
            USER_CHECK_COLUMNS, now)
        start = now.date()
    return history.read()


def run_day_accounting(spark, sf_dir):
    """What became of the rows of each window, by source; the repeated day had an empty window."""
    counts = _daily_runs(spark, sf_dir)["run_counts"].where("window_start < window_end")
    return counts.select("window_end", "source", "outcome", "rows")


def rentals_as_of_user(spark, sf_dir):
    """Rentals with the version of their user that was valid when they ended."""
    history = daily_user_history(spark, sf_dir)
    rentals = _rentals(spark, sf_dir).select("rental_id", "user_id", "rental_end_time")
    return as_of_join(rentals, history, "user_id", "rental_end_time", ["is_active", "update_at"])


QUERIES = {
    f.__name__: f for f in [
        clean_users, casted_vehicles, clean_vehicles, clean_locations, location_enrichment,
        epoch_nanos_to_datetime, clean_transactions_incremental, fact_incremental,
        keyed_update_users, scd2_users_two_batches, scd2_vehicles_two_batches,
        current_users_after_two_batches, scd2_history_closed_form, dim_users, dim_vehicles,
        dim_locations, fact_transactions, fact_quarantine, denormalized_transactions,
        weekend_split, user_favourites, vehicle_favourites, users_summary, vehicles_summary,
        daily_performance, daily_top_users, daily_top_vehicles, daily_top_entities,
        window_extract_users, window_extract_vehicles, window_extract_transactions,
        pending_window_counts, business_dates, profile_row_counts, profile_columns,
        profile_null_counts, profile_duplicate_keys, profile_duplicate_rows,
        profile_value_counts, peek_latest_rentals, dangling_new_ids, csv_roundtrip,
        parquet_extract_roundtrip, run_day_fact, run_day_quarantine, daily_user_history,
        run_day_dim_users, run_day_dim_vehicles, run_day_users_summary, run_day_vehicles_summary,
        run_day_daily_performance, run_day_daily_top_entities, run_day_accounting,
        rentals_as_of_user,
    ]
}
QUERIES["clean_transactions_full"] = _rentals
