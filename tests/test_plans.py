import datetime as dt

import pytest
from pyspark.sql import functions as F

from motorpool import schemas
from motorpool.plans import daily, marts, rollups, staging, star
from motorpool.plans.daily import absorb_rentals, extend_fact, run_day
from motorpool.sources import Warehouse
from motorpool.streaming import stream_rentals

from .conftest import executed_plan, rows_of

D, T = dt.date, dt.datetime
START = D(2025, 7, 1)


def user(key, name="Ana ", active=1, created=D(2025, 7, 1), updated=None):
    return (key, name, "Lee", None, "1", "AB1", D(2030, 1, 1), created, active, updated or created)


def vehicle(key, brand="b", active=1, updated="01-07-2025 08:00:00", kind="suv"):
    return (active, "0000001", "reg", "type", "01-01-2030", "p", D(2022, 12, 31), 2022, "t", "a",
            key, updated, brand, kind)


def rental(key, end, who="u1", what="v1", pickup="1", dropoff="2", amount=10.0, minutes=30):
    return (key, who, what, end - dt.timedelta(minutes=minutes), end, pickup, dropoff, amount)


def sources(spark, users, vehicles, rentals, places=(1, 2, 3)):
    cities = {1: "x", 2: "y", 3: "y"}
    return {
        "users": spark.createDataFrame(users, schemas.USERS),
        "vehicles": spark.createDataFrame(vehicles, schemas.VEHICLES),
        "transactions": spark.createDataFrame(rentals, schemas.TRANSACTIONS),
        "locations": spark.createDataFrame(
            [(i, f"l{i}", "a", cities[i], "ca", 90000 + i, 1.0, 2.0) for i in places],
            schemas.LOCATIONS),
    }


def opened(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.start_date().set(START, T(2025, 7, 1))
    return warehouse


def base(spark):
    return sources(
        spark,
        [user("u1"), user("u2", "Bo"), user(None), user("u1", "Old", created=D(2025, 6, 1),
                                                        updated=D(2025, 7, 1))],
        [vehicle("v1"), vehicle("v2", "c"), vehicle(None)],
        [rental("r1", T(2025, 7, 1, 10)), rental("r2", T(2025, 7, 2, 0, 10), "u2", "v2", "3", "1"),
         rental("r3", T(2025, 7, 2, 11), "u2", "v1", "2", "9"), rental("r4", T(2025, 7, 2, 12), "zz"),
         rental("r2", T(2025, 7, 1, 23), "u1", "v1"), rental(None, T(2025, 7, 2))],
    )


def test_one_day(spark, tmp_path):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20), as_of=D(2025, 7, 31))
    users = tables["dim_users"].select(
        "user_id", "full_name", "age_account", "age_account_segment", "is_active")
    assert rows_of(users) == [("u1", "ana lee", 30, "New", True), ("u2", "bo lee", 30, "New", True)]
    vehicles = tables["dim_vehicles"].select("vehicle_id", "age_vehicle", "age_vehicle_segment")
    assert rows_of(vehicles) == [("v1", 3, "Medium"), ("v2", 3, "Medium")]
    facts = tables["fact_transactions"].select("rental_id", "user_id", "rental_duration_days")
    assert rows_of(facts) == [("r1", "u1", 0), ("r2", "u2", 1)]
    assert tables["clean_transactions"].count() == 4
    assert rows_of(tables["left_out_transactions"].select("rental_id", "missing_references")) == [
        ("r3", "dropoff_location"), ("r4", "user_id")]
    assert rows_of(tables["users_summary"].select(
        "user_id", "total_transactions", "most_used_vehicle_brand", "most_used_pickup_city")
    ) == [("u1", 1, "b", "x"), ("u2", 1, "c", "y")]
    assert rows_of(tables["daily_performance"].select("rental_date", "total_transactions")) == [
        (D(2025, 7, 1), 1), (D(2025, 7, 2), 1)]
    top = tables["daily_top_entities"].orderBy("rental_date").collect()
    assert [[tuple(e) for e in r["top_users"]] for r in top] == [
        [("u1", "ana lee", 1)], [("u2", "bo lee", 1)]]
    assert spark.table("denormalized_transactions").columns == tables[
        "denormalized_transactions"].columns
    assert len(tables["denormalized_transactions"].columns) == 55
    # 20:00 UTC is already the next business day.
    assert warehouse.start_date().get() == D(2025, 7, 3)


def test_fresh_rentals_are_judged_by_one_chain_of_joins(spark, tmp_path, monkeypatch):
    warehouse, calls = opened(spark, tmp_path), []
    judge = star.judged_rentals
    monkeypatch.setattr(star, "judged_rentals", lambda *a: calls.append(judge(*a)) or calls[-1])
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    assert len(calls) == 1
    plan = executed_plan(calls[0])
    assert plan.count("BroadcastHashJoin") == 4  # one for each reference
    stored = spark.read.parquet(f"{warehouse.path('left_out_transactions')}/judged")
    assert rows_of(stored.select("rental_id", "outcome")) == [
        ("r1", "fact"), ("r2", "fact"), ("r3", "left_out"), ("r4", "left_out")]
    assert rows_of(tables["left_out_transactions"].select("rental_id", "missing_references")) == [
        ("r3", "dropoff_location"), ("r4", "user_id")]


def test_days_accumulate_and_repeats_change_nothing(spark, tmp_path):
    warehouse, first = opened(spark, tmp_path), base(spark)
    run_day(warehouse, first, T(2025, 7, 2, 20))
    again = sources(
        spark,
        [user("u2", "Bo", 0, updated=D(2025, 7, 3)), user("zz", created=D(2025, 7, 3))],
        [vehicle("v2", "c", 0, "03-07-2025 10:00:00")],
        [rental("r1", T(2025, 7, 3, 9), amount=99.0),      # a later version of r1
         rental("r0", T(2025, 7, 1, 1)),                   # late: before the window
         rental("r5", T(2025, 7, 3, 8), "u2", "v2")],
    )
    second = T(2025, 7, 3, 20)
    tables = run_day(warehouse, again, second)
    names = ["snapshot_users", "snapshot_vehicles", "clean_transactions", "fact_transactions",
             "left_out_transactions",
             "users_summary", "vehicles_summary", "daily_performance"]
    seen = {n: rows_of(tables[n]) for n in names}

    # r4 ended above the fact's mark, so it is tried again now that its user is known.
    facts = rows_of(tables["fact_transactions"].select("rental_id", "total_amount"))
    assert facts == [("r1", 99.0), ("r2", 10.0), ("r4", 10.0), ("r5", 10.0)]
    # Every landed row is accounted for; the first window holds the counts of the first run.
    counted = {(r["window_end"], r["source"], r["outcome"]): r["rows"] for r in tables["run_counts"].collect()}
    assert {k[0] for k in counted} == {D(2025, 7, 3), D(2025, 7, 4)}
    for day in {k[0] for k in counted}:
        for source in ("users", "vehicles", "transactions"):
            own = {o: n for (d, s, o), n in counted.items() if (d, s) == (day, source)}
            assert own["landed"] == own["keyless"] + own["late"] + own["duplicate"] + own["taken"] > 0
    assert counted[D(2025, 7, 3), "transactions", "keyless"] == counted[D(2025, 7, 3), "transactions", "duplicate"] == 1
    assert counted[D(2025, 7, 3), "clean_transactions", "left_out"] == 2
    # r3 ended below the mark r5 and r4 set: it is listed for good.
    clean, out = tables["clean_transactions"], tables["left_out_transactions"]
    assert rows_of(out.select("rental_id", "missing_references")) == [("r3", "dropoff_location")]
    both = tables["fact_transactions"].select("rental_id").unionByName(out.select("rental_id"))
    assert rows_of(both) == rows_of(clean.select("rental_id"))
    history = tables["snapshot_users"].where("user_id = 'u2'").orderBy("valid_from")
    assert [(r["is_active"], r["valid_to"]) for r in history.collect()] == [
        (True, second), (False, None)]
    assert warehouse.history("snapshot_users").partitions() == ["2025-07-03", "open"]
    assert warehouse.start_date().get() == D(2025, 7, 4)

    # The same day again: the window is empty by now.
    repeat = run_day(warehouse, again, second)
    assert {n: rows_of(repeat[n]) for n in names} == seen
    # And as after a crash just before the start date was written.
    warehouse.start_date().set(D(2025, 7, 3), T(2025, 7, 3, 21))
    repeat = run_day(warehouse, again, second)
    assert {n: rows_of(repeat[n]) for n in names} == seen


def test_a_run_writes_only_what_its_sources_changed(spark, tmp_path):
    warehouse, first = opened(spark, tmp_path), base(spark)
    now = T(2025, 7, 2, 20)
    derived = ["dim_users", "dim_vehicles", "users_summary", "vehicles_summary"]
    histories = ["snapshot_users", "snapshot_vehicles"]

    def numbers():
        return {n: warehouse.generation(n) for n in derived} | {n: warehouse.history(n).generation for n in histories}

    seen = run_day(warehouse, first, now)
    rows = {n: rows_of(seen[n]) for n in derived + histories}
    assert set(numbers().values()) == {0}
    # The window is empty now: histories, dimensions and summaries stay.
    again = run_day(warehouse, first, now)
    assert set(numbers().values()) == {0}
    assert {n: rows_of(again[n]) for n in derived + histories} == rows
    # Ages count up to another day: no history is written, the dimensions are, and what they label.
    tables = run_day(warehouse, first, now, as_of=D(2026, 7, 5))
    assert numbers() == dict.fromkeys(derived, 1) | dict.fromkeys(histories, 0)
    assert {r["age_account"] for r in tables["users_summary"].collect()} == {369}
    # A rental more: the dimensions stay, the summaries follow the partials.
    more = sources(spark, [], [], [rental("r8", T(2025, 7, 3, 9), "u2")])
    tables = run_day(warehouse, more, T(2025, 7, 3, 20), as_of=D(2026, 7, 5))
    assert numbers() == dict.fromkeys(derived, 1) | dict.fromkeys(histories, 0) | {
        "users_summary": 2, "vehicles_summary": 2}
    totals = tables["users_summary"].select("user_id", "total_transactions")
    assert rows_of(totals) == rows_of(
        tables["fact_transactions"].groupBy("user_id").agg(F.count("*").alias("n")))
    # A renamed user: their history, dimension and label, and nothing of the vehicles' dimension.
    named = sources(spark, [user("u2", "Zoe", updated=D(2025, 7, 4))], [], [])
    tables = run_day(warehouse, named, T(2025, 7, 4, 20), as_of=D(2026, 7, 5))
    assert numbers() == {
        "dim_users": 2, "dim_vehicles": 1, "users_summary": 3, "vehicles_summary": 3,
        "snapshot_users": 1, "snapshot_vehicles": 0}
    assert "zoe lee" in {r["full_name"] for r in tables["users_summary"].collect()}


def test_a_total_of_money_is_worked_out_once_for_both_columns(spark, tmp_path):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    plan = executed_plan(rollups.users_summary(warehouse, tables["dim_users"], tables["dim_vehicles"]))
    assert "_money" in plan


def test_marts_equal_the_wide_view(spark, tmp_path):
    """The marts skip the wide view; grouping the view itself gives the same rows."""
    warehouse = opened(spark, tmp_path)
    many = [rental(f"r{i}", T(2025, 7, 1 + i % 3, 10), f"u{1 + i % 2}", f"v{1 + i % 3 % 2}",
                   str(1 + i % 3), str(1 + i % 2), 0.1 * i) for i in range(60)]
    data = sources(spark, [user("u1"), user("u2")], [vehicle("v1"), vehicle("v2", "c")], many)
    run_day(warehouse, data, T(2025, 7, 4, 1))
    # The seed loses a location: the fact keeps its rentals, the view and marts do not.
    fewer = sources(spark, [user("u1")], [vehicle("v1")], many[:1], places=(1, 2))
    tables = run_day(warehouse, fewer, T(2025, 7, 4, 2))
    wide = tables["denormalized_transactions"]
    assert tables["fact_transactions"].count() == 60
    assert wide.count() == 40
    for key, mart in [("user_id", "users_summary"), ("vehicle_id", "vehicles_summary")]:
        by_key = wide.groupBy(key).agg(F.count("*").alias("n"), F.min("rental_start_time").alias("t"))
        first = {"users_summary": "first_transaction_date", "vehicles_summary": "first_rented"}[mart]
        assert rows_of(by_key) == rows_of(tables[mart].select(key, "total_transactions", first))
    by_day = wide.groupBy(F.to_date("rental_end_time")).agg(
        F.count("*"), F.countDistinct("user_id"), F.countDistinct("pickup_city"))
    assert rows_of(by_day) == rows_of(tables["daily_performance"].select(
        "rental_date", "total_transactions", "unique_users", "unique_pickup_cities"))
    spent = tables["daily_performance"].agg(F.sum("total_spent")).first()[0]
    assert spent == pytest.approx(wide.agg(F.sum("total_amount")).first()[0])


def generations(warehouse, *names):
    states = {n: warehouse.partials(n, "period") for n in rollups.PARTIALS} | {n: warehouse.daily(n) for n in names}
    return {n: dict(s.live) for n, s in states.items()}


def test_a_run_rebuilds_touched_days_only_and_equals_a_full_build(spark, tmp_path):
    warehouse = opened(spark, tmp_path)
    days = ["daily_performance", "daily_top_users", "daily_top_vehicles"]
    many = [rental(f"r{i}", T(2025, 7, 1 + i % 4, 10), f"u{1 + i % 3}", f"v{1 + i % 2}",
                   str(1 + i % 3), str(1 + i % 2), 0.1 * i - 1e-7) for i in range(40)]
    people = [user(f"u{k}", f"N{k}") for k in (1, 2, 3)]
    run_day(warehouse, sources(spark, people, [vehicle("v1"), vehicle("v2", "c")], many), T(2025, 7, 5, 1))
    before = generations(warehouse, *days)
    assert set(before["usage"]) == {f"2025-07-0{d}" for d in (1, 2, 3, 4)}

    # r1 of the second day ends again on the sixth, u2 gets another name, r90 is new.
    later = [rental("r1", T(2025, 7, 6, 9), "u2", "v2", amount=7.5), rental("r90", T(2025, 7, 6, 9), "u1")]
    second = sources(spark, [user("u2", "Zoe", updated=D(2025, 7, 6))], [], later)
    tables = run_day(warehouse, second, T(2025, 7, 7, 1))
    after = generations(warehouse, *days)
    for name, live in after.items():
        changed = {p for p in live if live[p] != before[name].get(p)}
        assert changed == {"2025-07-02", "2025-07-06"}, name

    dimensions = [tables[n] for n in ("dim_users", "dim_vehicles", "dim_locations")]
    fact = tables["fact_transactions"]
    whole = {
        "users_summary": marts.users_summary(fact, *dimensions),
        "vehicles_summary": marts.vehicles_summary(fact, *dimensions),
        "daily_performance": marts.daily_performance(fact, dimensions[2]),
        "daily_top_entities": marts.daily_top_entities(fact, *dimensions),
    }
    for name, rows in whole.items():
        assert tables[name].columns == rows.columns
        assert rows_of(tables[name]) == rows_of(rows), name
    assert "zoe lee" in {r["full_name"] for r in tables["users_summary"].collect()}
    # Nothing new: nothing is worked out.
    facts = warehouse.rentals("fact_transactions")
    assert rollups.touched_periods(warehouse, facts, dimensions[2]) == set()
    # A location that vanishes decides on rentals of any day.
    fewer = dimensions[2].where("location_id <> '3'")
    assert rollups.refresh(warehouse, facts, fewer) == set(facts.live)
    assert rows_of(rollups.users_summary(warehouse, *dimensions[:2])) == rows_of(
        marts.users_summary(fact, *dimensions[:2], fewer))


def test_a_period_is_written_once_and_aggregated_by_year_only(spark, tmp_path):
    warehouse = opened(spark, tmp_path)
    many = [rental(f"r{i}", T(2025, 7, 1 + i % 3, 10), f"u{1 + i % 2}") for i in range(12)]
    run_day(warehouse, sources(spark, [user("u1"), user("u2")], [vehicle("v1")], many), T(2025, 7, 5, 1))
    assert warehouse.partials("usage", "period").read().count() == 12
    for name in ("user_totals", "vehicle_totals", "user_cities", "vehicle_cities"):
        assert not warehouse.partials(name, "period").exists()
        assert warehouse.partials(name, "year").partitions() == ["2025"]
    assert rows_of(rollups.yearly(warehouse, "usage").select("user_id", "vehicle_id", "n")) == [
        ("u1", "v1", 6), ("u2", "v1", 6)]


def test_marts_with_shuffled_dimensions_are_the_same(spark, tmp_path, no_broadcast):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    dimensions = [tables[n] for n in ("dim_users", "dim_vehicles", "dim_locations")]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact = tables["fact_transactions"]
    for name, build in [("users_summary", marts.users_summary),
                        ("vehicles_summary", marts.vehicles_summary)]:
        assert rows_of(build(fact, *dimensions)) == rows_of(tables[name])
    wide = star.denormalized_transactions(fact, *dimensions)
    assert rows_of(wide) == rows_of(tables["denormalized_transactions"])


def test_only_the_last_partition_gives_the_mark(spark, tmp_path):
    warehouse = opened(spark, tmp_path)
    run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    marked = daily._marked_by(warehouse.rentals("clean_transactions"))
    assert {f.split("part=")[1][:10] for f in marked.inputFiles()} == {"2025-07-02"}


def test_summaries_scan_narrow_columns_and_do_not_shuffle_rentals(spark, tmp_path):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    plan = executed_plan(marts.daily_performance(tables["fact_transactions"], tables["dim_locations"]))
    assert "rental_id" not in plan
    before_joins = plan[plan.index("BroadcastHashJoin [dropoff_location"):]
    assert "hashpartitioning(user_id" not in before_joins


def test_location_text_is_normalised(spark):
    raw = spark.createDataFrame([(7, " Jo's\t", "1 Main ST ", "MODESTO", "CA", 94540, 1.0, 2.0)],
                                schemas.LOCATIONS)
    enriched = staging.location_enrichment(staging.clean_locations(raw))
    assert tuple(enriched.first()) == ("7", "jo's", "1 main st", "modesto", "ca", "94540", 1.0, 2.0)


def test_streamed_files_equal_the_daily_batches(spark, tmp_path):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    dimensions = [tables[n] for n in ("dim_users", "dim_vehicles", "dim_locations")]
    other = Warehouse(spark, str(tmp_path / "streamed"))
    folder = str(tmp_path / "arrivals")

    def arrive(rows):
        spark.createDataFrame(rows, schemas.TRANSACTIONS).coalesce(1).write.mode("append").parquet(folder)
        stream_rentals(other, folder, str(tmp_path / "checkpoint"), dimensions).awaitTermination()
        return rows_of(other.rentals("fact_transactions").read().select("rental_id", "total_amount"))

    assert arrive([rental("r1", T(2025, 7, 1, 10)), rental("rx", T(2025, 7, 1, 11), "zz")]) == [
        ("r1", 10.0)]
    assert arrive([rental("r1", T(2025, 7, 2, 9), amount=5.0), rental("r9", T(2025, 7, 1, 9))]) == [
        ("r1", 5.0)]  # r9 is late


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_files_per_batch_decides_nothing(spark, tmp_path, files_per_batch):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    dimensions = [tables[n] for n in ("dim_users", "dim_vehicles", "dim_locations")]
    rows = [rental("r3", T(2025, 7, 1, 12)), rental("r2", T(2025, 7, 1, 11)),
            rental("r2", T(2025, 7, 1, 10), amount=5.0), rental("r1", T(2025, 7, 1, 9))]
    folder = str(tmp_path / "arrivals")
    for row in rows:  # newest first: end times fall from file to file
        spark.createDataFrame([row], schemas.TRANSACTIONS).coalesce(1).write.mode("append").parquet(folder)
    streamed, whole = (Warehouse(spark, str(tmp_path / name)) for name in ("streamed", "whole"))
    stream_rentals(streamed, folder, str(tmp_path / "checkpoint"), dimensions, files_per_batch)
    absorb_rentals(whole, spark.createDataFrame(rows, schemas.TRANSACTIONS))
    extend_fact(whole, *dimensions)
    for table in ("clean_transactions", "fact_transactions"):
        got, expected = (rows_of(w.rentals(table).read().select("rental_id", "rental_end_time", "total_amount"))
                         for w in (streamed, whole))
        assert got == expected
        assert [r[0] for r in got] == ["r1", "r2", "r3"]


def test_the_wide_view_meets_users_and_vehicles_while_rows_are_narrow(spark, tmp_path, monkeypatch):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    joins, plain = [], star.lookup_join

    def noted(rows, lookup, key, spread_by, how="inner", sample_of=None):
        joins.append((key, sample_of))
        return plain(rows, lookup, key, spread_by, how, sample_of)

    monkeypatch.setattr(star, "lookup_join", noted)
    dimensions = [tables[n] for n in ("dim_users", "dim_vehicles", "dim_locations")]
    rentals = tables["clean_transactions"]
    wide = star.denormalized_transactions(tables["fact_transactions"], *dimensions, rentals)
    assert joins == [(c, rentals) for c in ("user_id", "vehicle_id", "pickup_location", "dropoff_location")]
    assert rows_of(wide) == rows_of(tables["denormalized_transactions"])


@pytest.mark.parametrize("limit, times", [("-1", 1), ("64m", 0)])
def test_rows_between_two_shuffled_joins_can_be_stored(spark, tmp_path, limit, times):
    warehouse = opened(spark, tmp_path)
    tables = run_day(warehouse, base(spark), T(2025, 7, 2, 20))
    dimensions = [tables[n] for n in ("dim_users", "dim_vehicles", "dim_locations")]
    stored = []

    def keep(rows):
        stored.append(rows.columns)
        rows.write.parquet(str(tmp_path / "between"))
        return spark.read.parquet(str(tmp_path / "between"))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        wide = star.denormalized_transactions(tables["fact_transactions"], *dimensions, stored=keep)
        assert rows_of(wide) == rows_of(tables["denormalized_transactions"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(stored) == times
    assert all("email" in columns and "brand" not in columns for columns in stored)
