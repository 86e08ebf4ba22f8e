"""The daily run: extract a window, update history and fact, rebuild the marts."""

import datetime as dt
import json
from functools import partial

from pyspark.sql import functions as F

from ..functions import business_today
from ..operators import above_mark, scd2_step, undated, window_filter
from ..operators.extract import WINDOW_COLUMNS
from ..schemas import USER_CHECK_COLUMNS, VEHICLE_CHECK_COLUMNS
from ..session import shuffles_dropped
from ..sources import land_extract, load_raw
from ..sources.warehouse import OPEN, UNDATED
from . import accounting, rollups, staging, star
from .rollups import together


def extract_window(warehouse, sources, start, today):
    """Land the window ``[start, today)`` of every source and return the raw tables."""
    yesterday = today - dt.timedelta(days=1)

    def extract(table, column):
        rows = window_filter(sources[table], column, start, today)
        return load_raw(warehouse.spark, land_extract(rows, warehouse.landing(), table, yesterday))

    return together({t: partial(extract, t, c) for t, c in WINDOW_COLUMNS.items()})


def snapshot(warehouse, name, batch, key, check_columns, seen_at):
    """One history step. Versions closed on earlier days are neither read nor written; an empty batch
    leaves all as it is."""
    history = warehouse.history(name)
    batch = history.staged(batch)
    if history.exists() and batch.isEmpty():
        return history
    touched = [OPEN, seen_at.date().isoformat()]
    history.commit(scd2_step(history.read(touched), batch, key, check_columns, seen_at), touched)
    return history


def _newest(state):
    return max((p for p in state.partitions() if p != UNDATED), default=None)


def _marked_by(state):
    """The part of a rentals table that holds its greatest end time."""
    newest = _newest(state)
    return state.read() if newest is None else state.read([newest])


def absorb_rentals(warehouse, raw):
    """Merge a raw batch into the clean rentals."""
    clean = warehouse.rentals("clean_transactions")
    clean.merge(staging.clean_transactions(raw, _marked_by(clean)), ["rental_id"])
    return clean


def extend_fact(warehouse, users, vehicles, locations):
    """Merge the clean rentals above the fact's own mark into the fact.

    Each fresh rental is judged once; the result is stored by outcome, and both tables read it. Those
    that stay out are listed first, in ``left_out_transactions``, with the references they miss, in
    place of what was listed for any fresh rental: a run that dies in between lists the same
    again. What is listed below the fact's mark stays for good, with the references
    that were missing when it was last tried.
    """
    clean, fact = warehouse.rentals("clean_transactions"), warehouse.rentals("fact_transactions")
    newest = _newest(fact)
    rentals = clean.read([p for p in clean.partitions() if newest is None or p >= newest])
    left_out = warehouse.rentals("left_out_transactions")
    fresh = above_mark(rentals, _marked_by(fact), "rental_end_time")
    judged = left_out.staged(star.judged_rentals(fresh, users, vehicles, locations), "judged", ["outcome"])
    left_out.replace(judged.where("outcome = 'left_out'").drop("outcome"), judged, ["rental_id"])
    valid = star.fact_columns(judged.where("outcome = 'fact'"))
    fact.replace(valid, valid, ["rental_id"])
    return fact


def build_marts(warehouse, fact, users, vehicles, locations):
    """The wide view and the four marts, brought up to the fact by its touched periods.

    Users and vehicles are the stored dimensions. A summary is built again if they or the partials it
    adds up were written since.
    """
    wide = star.denormalized_transactions(fact.read(), users, vehicles, locations)
    warehouse.materialize("denormalized_transactions", "view", wide)
    rollups.refresh(warehouse, fact, locations)
    plans = {
        "users_summary": rollups.users_summary(warehouse, users, vehicles),
        "vehicles_summary": rollups.vehicles_summary(warehouse, users, vehicles),
    }
    sources = {name: warehouse.generation(name) for name in ("dim_users", "dim_vehicles")}
    built_from = json.dumps(sources | rollups.generations(warehouse))
    written = together({
        name: partial(warehouse.materialize, name, "table", rows, built_from) for name, rows in plans.items()
    })
    tops = rollups.daily_top_entities(warehouse, users, vehicles)
    return {
        "denormalized_transactions": wide, **written,
        "daily_performance": warehouse.daily("daily_performance").read(),
        "daily_top_entities": warehouse.materialize("daily_top_entities", "view", tops),
    }


def run_day(warehouse, sources, now_utc, as_of=None):
    """Run one day and return its relations by name.

    ``sources`` holds the users, vehicles and transactions tables and the locations
    seed. Every step is repeatable: the next start date is written last, and a repeated
    history or merge step finds nothing new.
    """
    with shuffles_dropped(warehouse.spark):
        return _run_day(warehouse, sources, now_utc, as_of)


def _run_day(warehouse, sources, now_utc, as_of):
    today = business_today(now_utc)
    as_of = as_of or today
    start_date = warehouse.start_date()
    start, counts = start_date.get(), {}
    raw = extract_window(warehouse, sources, start, today)

    def place():
        seed = staging.location_enrichment(sources["locations"])
        enriched = warehouse.materialize("location_enrichment", "seed", seed)
        located = warehouse.materialize("dim_locations", "table", star.dim_locations(enriched))
        return {"location_enrichment": enriched, "dim_locations": located}

    def known_from(history):
        return json.dumps({"history": history.generation, "as_of": str(as_of)})

    def know_users():
        batch = staging.clean_users(raw["users"])
        history = snapshot(
            warehouse, "snapshot_users", batch, "user_id", USER_CHECK_COLUMNS, now_utc)
        keyed = raw["users"].where("user_id IS NOT NULL")
        counts["users"] = accounting.of_source(raw["users"], "user_id", keyed, history.last_staged())
        users = star.dim_users(history.read([OPEN]), as_of)
        return {
            "snapshot_users": history.read(),
            "dim_users": warehouse.materialize("dim_users", "table", users, known_from(history)),
        }

    def know_vehicles():
        batch = staging.clean_vehicles(staging.casted_vehicles(raw["vehicles"]))
        history = snapshot(
            warehouse, "snapshot_vehicles", batch, "vehicle_id", VEHICLE_CHECK_COLUMNS, now_utc)
        keyed = raw["vehicles"].where("vehicle_id IS NOT NULL")
        counts["vehicles"] = accounting.of_source(raw["vehicles"], "vehicle_id", keyed, history.last_staged())
        vehicles = star.dim_vehicles(history.read([OPEN]), as_of)
        return {
            "snapshot_vehicles": history.read(),
            "dim_vehicles": warehouse.materialize("dim_vehicles", "table", vehicles, known_from(history)),
        }

    def take_rentals():
        keyed = staging.keyed_transactions(raw["transactions"])
        # The mark is that of before the merge, whose folders stay where they are.
        fresh = above_mark(keyed, _marked_by(warehouse.rentals("clean_transactions")), "rental_end_time")
        clean = absorb_rentals(warehouse, raw["transactions"])
        counts["transactions"] = accounting.of_source(
            raw["transactions"], "rental_id", fresh, clean.last_staged())
        return {"clean_transactions": clean.read()}

    def count_undated():
        return {table: undated(sources[table], column).count() for table, column in WINDOW_COLUMNS.items()}

    steps = [place, know_users, know_vehicles, take_rentals, count_undated]
    done = together({f.__name__: f for f in steps})
    for table, n in done.pop("count_undated").items():
        counts[table]["undated"] = n
    tables = {name: rows for part in done.values() for name, rows in part.items()}
    dimensions = [tables[n] for n in ("dim_users", "dim_vehicles", "dim_locations")]
    fact = extend_fact(warehouse, *dimensions)
    judged = warehouse.rentals("left_out_transactions").last_staged("judged", "rental_id string, outcome string")
    counts["clean_transactions"] = {"fact": 0, "left_out": 0, **dict(judged.groupBy("outcome").count().collect())}
    tables["fact_transactions"] = fact.read()
    tables["left_out_transactions"] = warehouse.rentals("left_out_transactions").read()
    tables |= build_marts(warehouse, fact, *dimensions)
    run_counts = accounting.RunCounts(warehouse.spark, warehouse.counts_path())
    run_counts.add(start, today, now_utc, counts)
    tables["run_counts"] = run_counts.read()
    start_date.set(today, now_utc)
    return tables
