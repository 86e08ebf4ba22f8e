"""The marts kept up to date by the periods of the fact that a run touched.

For each period of the fact (a folder of it, a calendar day as a rule) the rentals whose places exist are
kept with the columns the marts need. A run works out those of the periods whose folders are newer than the
last build, from these folders alone; what a replaced rental once added goes with the old content of its
period, so nothing is ever subtracted. A period is not aggregated: a user has hardly two rentals in one, so its
aggregates are as many rows as it has rentals. Partial aggregates that add up are kept by year: measures of a user and of a
vehicle, rentals of a user with a vehicle, and their cities. The summaries read as many rows a user as
there are years, and of the periods only those of touched years. Sums of money are exact
integers inside, hence equal to those of a full build. Daily marts have no state beyond their day: their touched
periods are replaced.

Names of users, labels of vehicles join at the end and need no rebuild. A location decides which
rentals count: the places of the last build are stored, and if any came, went or changed its city,
all periods are worked out anew.
"""

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import functions as F

from ..functions import money_merged, money_parts, money_value
from ..operators import mode_by
from . import marts

def together(steps):
    """Results by name of independent steps, whose jobs share the cluster: one step
    fills the executors that the last tasks of another leave idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = {name: pool.submit(step) for name, step in steps.items()}
        return {name: future.result() for name, future in running.items()}


YEAR = 4  # letters of a period's label


def _measures():
    amount, days = F.col("total_amount"), F.col("rental_duration_days")
    return [
        F.count("*").alias("n"), F.count(amount).alias("paid"), money_parts(amount).alias("money"),
        F.max(amount).alias("highest"), F.min(amount).alias("lowest"),
        F.min("rental_start_time").alias("first"), F.max("rental_start_time").alias("last"),
        F.sum(days).alias("days"), F.count(days).alias("timed"),
    ]


def _measures_merged():
    adding = ["n", "paid", "days", "timed"]
    return [
        *[F.sum(c).alias(c) for c in adding], money_merged(F.col("money")).alias("money"),
        F.max("highest").alias("highest"), F.min("lowest").alias("lowest"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    ]


def _count():
    return [F.count("*").alias("n")]


#: What is kept by period: the rentals the marts count.
PARTIALS = ["usage"]

#: Partial aggregates by year: their key, how rentals become one.
YEARLY = {
    "user_totals": (["user_id"], _measures),
    "vehicle_totals": (["vehicle_id"], _measures),
    "usage": (["user_id", "vehicle_id"], _count),
    "user_cities": (["user_id", "pickup_city", "dropoff_city"], _count),
    "vehicle_cities": (["vehicle_id", "pickup_city", "dropoff_city"], _count),
}


def _refresh(warehouse, name, rentals, years):
    keys, measures = YEARLY[name]
    # A task of the aggregate meets a handful of years, so it writes them itself.
    warehouse.partials(name, "year").commit(
        rentals.groupBy("period", *keys).agg(*measures()), years, rebalanced=False)


def yearly(warehouse, name):
    """A partial aggregate, one row a key and year."""
    return warehouse.partials(name, "year").read()


def generations(warehouse):
    """The number of each yearly partial's content."""
    return {name: warehouse.partials(name, "year").generation for name in YEARLY}


def total(warehouse, name):
    """The measures of a key over all years."""
    return yearly(warehouse, name).groupBy(*YEARLY[name][0]).agg(*_measures_merged())


def _places(locations):
    return locations.select("location_id", "city")


def touched_periods(warehouse, fact, locations):
    """Periods to work out anew: those written since the last build, or gone; all after a change of places."""
    built, known = warehouse.partials("places", "all"), warehouse.partials("usage", "period").partitions()
    if not built.exists() or not built.live:
        return set(fact.live) | set(known)
    stored = built.read()
    here, there = _places(locations), stored.select("location_id", "city")
    if not here.exceptAll(there).isEmpty() or not there.exceptAll(here).isEmpty():
        return set(fact.live) | set(known)
    last = stored.agg(F.max("generation")).first()[0]
    return {p for p, written in fact.live.items() if written > last} | (set(known) - set(fact.live))


def refresh(warehouse, fact, locations):
    """Bring the partials and the daily marts up to the fact; returns the periods worked out anew."""
    touched = touched_periods(warehouse, fact, locations)
    if touched:
        rows = fact.read(sorted(touched)).withColumn("period", fact.part)
        narrow = marts.located(rows, locations, ["city"]).select(
            "period", "user_id", "vehicle_id", "rental_start_time", "rental_end_time",
            "rental_duration_days", "pickup_city", "dropoff_city", "total_amount")
        # Read by all that follows. Each task scans few periods and writes them itself.
        kept = warehouse.partials("usage", "period")
        kept.commit(narrow, touched, rebalanced=False)
        years = {p[:YEAR] for p in touched}
        by_year = kept.read([p for p in kept.partitions() if p[:YEAR] in years]).withColumn(
            "period", F.substring("period", 1, YEAR))
        narrow = kept.read(sorted(touched))
        steps = {name: partial(_refresh, warehouse, name, by_year, years) for name in YEARLY}
        steps["daily_performance"] = partial(
            warehouse.daily("daily_performance").commit, marts.performance(narrow, narrow), touched)
        for name, key, count in TOPS:
            steps[name] = partial(warehouse.daily(name).commit, marts.daily_top(narrow, key, count), touched)
        together(steps)
    # Written last: a run that dies before works out the same periods again.
    generation = F.lit(fact.generation).cast("bigint").alias("generation")
    warehouse.partials("places", "all").commit(
        _places(locations).select("*", generation, F.lit("all").alias("period")))
    return touched


TOPS = [
    ("daily_top_users", "user_id", "transactions_per_user"),
    ("daily_top_vehicles", "vehicle_id", "transactions_per_vehicle"),
]


def _named(totals, key, names):
    total, average, highest, lowest, first, last, days, mean = names
    # By name, so that it is worked out once for both columns.
    money = F.col("_money")
    return totals.withColumn("_money", money_value(F.col("money"))).select(
        key, F.col("n").alias("total_transactions"), money.alias(total), (money / F.col("paid")).alias(average),
        F.col("highest").alias(highest), F.col("lowest").alias(lowest), F.col("first").alias(first),
        F.col("last").alias(last), F.col("days").alias(days), (F.col("days") / F.col("timed")).alias(mean))


def users_summary(warehouse, users, vehicles):
    totals = _named(total(warehouse, "user_totals"), "user_id", [
        "total_spending", "average_spending", "max_spending", "min_spending", "first_transaction_date",
        "last_transaction_date", "total_rental_days", "avg_rental_duration_days"])
    cities = mode_by(yearly(warehouse, "user_cities"), "user_id", {
        "most_used_pickup_city": "pickup_city", "most_used_dropoff_city": "dropoff_city"}, weight="n")
    labels = vehicles.select("vehicle_id", "brand", "vehicle_type")
    driven = mode_by(yearly(warehouse, "usage").join(labels, "vehicle_id"), "user_id", {
        "most_used_vehicle_id": "vehicle_id", "most_used_vehicle_brand": "brand",
        "most_used_vehicle_type": "vehicle_type"}, weight="n")
    return marts.label_users(totals, driven.join(cities, "user_id"), users)


def vehicles_summary(warehouse, users, vehicles):
    totals = _named(total(warehouse, "vehicle_totals"), "vehicle_id", [
        "total_revenue", "average_revenue", "max_revenue", "min_revenue", "first_rented", "last_rented",
        "total_days_rented", "avg_days_rented"])
    cities = mode_by(yearly(warehouse, "vehicle_cities"), "vehicle_id", {
        "most_frequent_pickup_city": "pickup_city", "most_frequent_dropoff_city": "dropoff_city"}, weight="n")
    drivers = mode_by(yearly(warehouse, "usage"), "vehicle_id", {"most_frequent_user_id": "user_id"}, weight="n")
    return marts.label_vehicles(totals, cities.join(drivers, "vehicle_id"), users, vehicles)


def daily_top_entities(warehouse, users, vehicles):
    """The stored tops, labelled and gathered by day."""
    return marts.entities_in_arrays(
        marts.name_top_users(warehouse.daily("daily_top_users").read(), users),
        marts.name_top_vehicles(warehouse.daily("daily_top_vehicles").read(), vehicles))
