"""Reporting marts over the star.

The marts report per user, per vehicle and per day on the wide view. They are built
from the fact instead: rentals are aggregated on the narrow columns a mart needs, and
a dimension that only labels the result joins the aggregate. The rows thus never
shuffle to meet users or vehicles. The result is that of the wide view, because every
fact row has its user and vehicle, and histories never lose a key.
"""

from pyspark.sql import functions as F

from ..functions import calendar_date, money_average, money_total
from ..operators import mode_by, top_per_group
from .star import at_location


def located(fact, locations, columns=()):
    """Rentals whose locations still exist, with columns of both ends."""
    rows = at_location(fact, locations, "pickup", columns, fact)
    return at_location(rows, locations, "dropoff", columns, fact)


def _measures(total, average, highest, lowest):
    amount = F.col("total_amount")
    return [
        money_total(amount).alias(total),
        money_average(amount).alias(average),
        F.max(amount).alias(highest),
        F.min(amount).alias(lowest),
    ]


def _days(total, average):
    days = F.col("rental_duration_days")
    return [F.sum(days).alias(total), F.avg(days).alias(average)]


def user_favourites(fact, vehicles, locations):
    """Per user the most used vehicle, brand, type, pickup city and dropoff city.

    Rentals are counted by user and vehicle first; the labels join those counts, so no
    rental moves to meet its vehicle.
    """
    rentals = located(fact, locations, ["city"])
    cities = mode_by(rentals, "user_id", {
        "most_used_pickup_city": "pickup_city",
        "most_used_dropoff_city": "dropoff_city",
    })
    used = rentals.groupBy("user_id", "vehicle_id").agg(F.count("*").alias("_rentals"))
    labels = vehicles.select("vehicle_id", "brand", "vehicle_type")
    driven = mode_by(used.join(labels, "vehicle_id"), "user_id", {
        "most_used_vehicle_id": "vehicle_id",
        "most_used_vehicle_brand": "brand",
        "most_used_vehicle_type": "vehicle_type",
    }, weight="_rentals")
    return driven.join(cities, "user_id")


def users_summary(fact, users, vehicles, locations):
    totals = located(fact, locations).groupBy("user_id").agg(
        F.count("*").alias("total_transactions"),
        *_measures("total_spending", "average_spending", "max_spending", "min_spending"),
        F.min("rental_start_time").alias("first_transaction_date"),
        F.max("rental_start_time").alias("last_transaction_date"),
        *_days("total_rental_days", "avg_rental_duration_days"),
    )
    return label_users(totals, user_favourites(fact, vehicles, locations), users)


def label_users(totals, favourites, users):
    """The mart of users from its three parts, one row per user each."""
    labels = users.select("user_id", "full_name", "age_account", "age_account_segment", "is_active")
    return totals.join(favourites, "user_id", "left").join(labels, "user_id").select(
        "user_id", "full_name", "age_account", "age_account_segment", "is_active",
        "total_transactions", "total_spending", "average_spending", "max_spending",
        "min_spending", "first_transaction_date", "last_transaction_date",
        "total_rental_days", "avg_rental_duration_days",
        "most_used_vehicle_id", "most_used_vehicle_brand", "most_used_vehicle_type",
        "most_used_pickup_city", "most_used_dropoff_city",
    )


def vehicle_favourites(fact, locations):
    """Per vehicle the most frequent pickup city, dropoff city and user."""
    return mode_by(located(fact, locations, ["city"]), "vehicle_id", {
        "most_frequent_pickup_city": "pickup_city",
        "most_frequent_dropoff_city": "dropoff_city",
        "most_frequent_user_id": "user_id",
    })


def vehicles_summary(fact, users, vehicles, locations):
    totals = located(fact, locations).groupBy("vehicle_id").agg(
        F.count("*").alias("total_transactions"),
        *_measures("total_revenue", "average_revenue", "max_revenue", "min_revenue"),
        F.min("rental_start_time").alias("first_rented"),
        F.max("rental_start_time").alias("last_rented"),
        *_days("total_days_rented", "avg_days_rented"),
    )
    return label_vehicles(totals, vehicle_favourites(fact, locations), users, vehicles)


def label_vehicles(totals, favourites, users, vehicles):
    """The mart of vehicles from its parts, one row per vehicle each."""
    names = users.select(
        F.col("user_id").alias("most_frequent_user_id"),
        F.col("full_name").alias("most_frequent_user_name"),
    )
    favourites = favourites.join(names, "most_frequent_user_id", "left")
    labels = vehicles.select(
        "vehicle_id", "vehicle_license_number", "active",
        F.col("brand").alias("vehicle_brand"), "vehicle_type", "age_vehicle",
        "age_vehicle_segment",
    )
    return totals.join(favourites, "vehicle_id", "left").join(labels, "vehicle_id").select(
        "vehicle_id", "vehicle_license_number", "active", "vehicle_brand", "vehicle_type",
        "age_vehicle", "age_vehicle_segment", "total_transactions", "total_revenue",
        "average_revenue", "max_revenue", "min_revenue", "first_rented", "last_rented",
        "total_days_rented", "avg_days_rented", "most_frequent_pickup_city",
        "most_frequent_dropoff_city", "most_frequent_user_id", "most_frequent_user_name",
    )


def daily_performance(fact, locations):
    """Per calendar day of the rental end."""
    return performance(located(fact, locations), located(fact, locations, ["city"]))


def performance(rentals, with_cities):
    """The same from rentals whose locations exist.

    The distinct counts multiply the rows they read by their number, so they run on
    their own four columns; the two results meet with one row per day.
    """
    day = calendar_date(F.col("rental_end_time"))
    totals = rentals.groupBy(day.alias("rental_date")).agg(
        F.count("*").alias("total_transactions"),
        *_measures("total_spent", "avg_spent", "max_spent", "min_spent"),
        *_days("total_rental_days", "avg_rental_duration_days"),
    )
    distinct = with_cities.groupBy(day.alias("_date")).agg(
        F.countDistinct("user_id").alias("unique_users"),
        F.countDistinct("vehicle_id").alias("unique_vehicles"),
        F.countDistinct("pickup_city").alias("unique_pickup_cities"),
        F.countDistinct("dropoff_city").alias("unique_dropoff_cities"),
    )
    date = F.col("rental_date")
    return totals.join(distinct, date.eqNullSafe(F.col("_date"))).select(
        F.year(date).cast("bigint").alias("rental_year"),
        F.month(date).cast("bigint").alias("rental_month"),
        F.dayofmonth(date).cast("bigint").alias("rental_day"),
        "rental_date", "total_transactions", "unique_users", "unique_vehicles",
        "total_spent", "avg_spent", "min_spent", "max_spent", "total_rental_days",
        "avg_rental_duration_days", "unique_pickup_cities", "unique_dropoff_cities",
    )


def daily_top(rentals, key, count_name):
    """One row per day and key with the day's highest number of rentals, without labels."""
    day = calendar_date(F.col("rental_end_time")).alias("rental_date")
    rows = rentals.select(day, key)
    # What the joins on top would filter anyway; said here, the counts are planned the
    # same wherever they are used, and shuffled once.
    rows = rows.where(F.col("rental_date").isNotNull() & F.col(key).isNotNull())
    return top_per_group(rows, "rental_date", key, count_name)


def daily_top_users(fact, users, locations):
    """One row per day and user with the day's highest number of rentals."""
    return name_top_users(daily_top(located(fact, locations), "user_id", "transactions_per_user"), users)


def name_top_users(top, users):
    names = users.select("user_id", "full_name")
    return top.join(names, "user_id").select("rental_date", "user_id", "full_name", "transactions_per_user")


def daily_top_vehicles(fact, vehicles, locations):
    top = daily_top(located(fact, locations), "vehicle_id", "transactions_per_vehicle")
    return name_top_vehicles(top, vehicles)


def name_top_vehicles(top, vehicles):
    labels = vehicles.select("vehicle_id", F.col("brand").alias("vehicle_brand"), "vehicle_type")
    return top.join(labels, "vehicle_id").select(
        "rental_date", "vehicle_id", "vehicle_brand", "vehicle_type", "transactions_per_vehicle"
    )


def _in_arrays(top, name):
    entry = F.struct(*[c for c in top.columns if c != "rental_date"])
    return top.groupBy("rental_date").agg(F.sort_array(F.collect_list(entry)).alias(name))


def daily_top_entities(fact, users, vehicles, locations):
    """Per day the top users and top vehicles as sorted arrays.

    A day's array holds all its ties; the two functions above give the same content
    one row per entry. Stored tables have no order; readers sort by rental_date.
    """
    return entities_in_arrays(
        daily_top_users(fact, users, locations), daily_top_vehicles(fact, vehicles, locations))


def entities_in_arrays(named_users, named_vehicles):
    top_users, top_vehicles = _in_arrays(named_users, "top_users"), _in_arrays(named_vehicles, "top_vehicles")
    return top_users.join(top_vehicles, "rental_date")
