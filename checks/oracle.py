"""The same results in DuckDB SQL, written as the plain joins and windows they mean."""

from motorpool.schemas import USER_CHECK_COLUMNS, VEHICLE_CHECK_COLUMNS

AS_OF = "DATE '2002-01-01'"
SPACES = r"e' \t'"


def trimmed(column):
    return f"trim(lower({column}), {SPACES})"


RAW_LOCATIONS = r"""
SELECT n_nationkey AS location_id, ' ' || n_name || e'\t' AS location_name,
       n_nationkey || ' Main STREET ' AS address, e'\t' || r_name AS city, 'CA ' AS state,
       CAST(n_nationkey + 90000 AS INTEGER) AS zip_code,
       CAST(n_nationkey * 1.5 AS DOUBLE) AS latitude,
       CAST(n_nationkey * 2.25 - 120 AS DOUBLE) AS longitude
FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def raw_users():
    copies = [
        ("CAST(c_custkey AS VARCHAR)", 0, "TRUE"),
        ("CAST(c_custkey AS VARCHAR)", 1, "c_acctbal > 5000"),
        ("CAST(NULL AS VARCHAR)", 0, "c_nationkey = 7"),
    ]
    return " UNION ALL ".join(rf"""
SELECT {key} AS user_id,
       '  ' || upper(split_part(c_name, '#', 1)) || e'\t' AS first_name,
       'No' || split_part(c_name, '#', 2) || ' ' AS last_name,
       'user' || c_custkey || '@example.org' AS email,
       '555-' || c_custkey AS phone_number, 'AB' || c_custkey AS driver_license_number,
       DATE '2003-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS driver_license_expiry,
       DATE '1995-01-01' + CAST(c_custkey * 977 % 2557 + {later} AS INTEGER) AS creation_date,
       CAST(c_acctbal > 0 AS INTEGER) AS is_active,
       DATE '1995-01-01' + CAST(c_custkey * 977 % 2557 + {later} AS INTEGER) AS update_at,
       c_mktsegment AS segment
FROM customer WHERE {condition}""" for key, later, condition in copies)


def raw_vehicles():
    copies = [
        ("CAST(p_partkey AS VARCHAR)", 600, "TRUE"),
        ("CAST(p_partkey AS VARCHAR)", 2000, "p_size <= 10"),
        ("CAST(NULL AS VARCHAR)", 600, "p_brand = 'Brand#3'"),
    ]
    certified = "(DATE '1990-01-01' + p_size * 87)"
    return " UNION ALL ".join(f"""
SELECT CAST(p_size > 10 AS INTEGER) AS active,
       CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 7
            THEN lpad(CAST(p_partkey AS VARCHAR), 7, '0')
            ELSE CAST(p_partkey AS VARCHAR) END AS vehicle_license_number,
       p_name AS registration_name,
       CASE WHEN p_size > 25 THEN 'FOR HIRE VEHICLE' ELSE 'LEASED VEHICLE' END AS license_type,
       strftime(DATE '2003-01-01' + CAST(p_partkey % 900 AS INTEGER), '%d-%m-%Y') AS expiration_date,
       'P' || p_partkey AS permit_license_number, {certified} AS certification_date,
       CAST(year({certified}) AS INTEGER) AS vehicle_year,
       '(555)' || p_partkey AS base_telephone_number, p_name || ' road' AS base_address,
       {key} AS vehicle_id,
       strftime({certified} + INTERVAL {minutes} MINUTE, '%d-%m-%Y %H:%M:%S') AS last_update_timestamp,
       p_brand AS brand, p_type AS vehicle_type
FROM part WHERE {condition}""" for key, minutes, condition in copies)


RAW_TRANSACTIONS = """
SELECT l_orderkey || '-' || l_linenumber AS rental_id, CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(l_partkey AS VARCHAR) AS vehicle_id,
       l_shipdate + to_minutes(CAST(l_orderkey % 1440 AS BIGINT)) - to_hours(CAST(l_quantity AS BIGINT))
         AS rental_start_time,
       l_shipdate + to_minutes(CAST(l_orderkey % 1440 AS BIGINT)) AS rental_end_time,
       CAST(s_nationkey AS VARCHAR) AS pickup_location,
       CAST((l_orderkey + l_linenumber) % 27 AS VARCHAR) AS dropoff_location,
       l_extendedprice AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
"""

CLEAN_LOCATIONS = f"""
SELECT location_id, {trimmed('location_name')} AS location_name, {trimmed('address')} AS address,
       {trimmed('city')} AS city, {trimmed('state')} AS state, zip_code, latitude, longitude
FROM raw_locations
"""

LOCATIONS = """
SELECT CAST(location_id AS VARCHAR) AS location_id, location_name, address, city, state,
       CAST(zip_code AS VARCHAR) AS zip_code, latitude, longitude
FROM clean_locations
"""


def clean_users(source):
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY user_id
      ORDER BY creation_date DESC NULLS LAST, update_at DESC NULLS LAST, first_name, last_name,
               email, phone_number, driver_license_number, driver_license_expiry, is_active) AS rn
  FROM (SELECT user_id, {trimmed('first_name')} AS first_name, {trimmed('last_name')} AS last_name,
               email, phone_number, driver_license_number, driver_license_expiry, creation_date,
               CAST(is_active AS BOOLEAN) AS is_active, update_at
        FROM {source} WHERE user_id IS NOT NULL)
) WHERE rn = 1
"""


def casted_vehicles(source):
    return f"""
SELECT vehicle_id, CAST(active AS BOOLEAN) AS active, vehicle_license_number, registration_name,
       license_type, CAST(strptime(expiration_date, '%d-%m-%Y') AS DATE) AS expiration_date,
       permit_license_number, certification_date, vehicle_year, base_telephone_number,
       base_address, strptime(last_update_timestamp, '%d-%m-%Y %H:%M:%S') AS last_update_timestamp,
       brand, vehicle_type
FROM {source}
"""


def clean_vehicles(casted):
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY vehicle_id ORDER BY last_update_timestamp DESC NULLS LAST, active,
      vehicle_license_number, registration_name, license_type, expiration_date,
      permit_license_number, certification_date) AS rn
  FROM ({casted}) WHERE vehicle_id IS NOT NULL
) WHERE rn = 1
"""


def clean_rentals(source, condition="TRUE"):
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY rental_id
      ORDER BY rental_end_time DESC NULLS LAST, rental_start_time DESC NULLS LAST, user_id,
               vehicle_id, pickup_location, dropoff_location, total_amount) AS rn
  FROM {source} WHERE rental_id IS NOT NULL AND ({condition})
) WHERE rn = 1
"""


def dim_users(source):
    return f"""
SELECT *, CASE WHEN age_account <= 30 THEN 'New' WHEN age_account <= 180 THEN 'Medium'
               ELSE 'Old' END AS age_account_segment
FROM (SELECT user_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email,
             phone_number, driver_license_number, driver_license_expiry, creation_date,
             date_diff('day', creation_date, {AS_OF}) AS age_account, is_active, update_at
      FROM {source})
"""


def dim_vehicles(source):
    return f"""
SELECT *, CASE WHEN age_vehicle <= 2 THEN 'New' WHEN age_vehicle <= 5 THEN 'Medium'
               ELSE 'Old' END AS age_vehicle_segment
FROM (SELECT *, date_diff('year', certification_date, {AS_OF}) AS age_vehicle FROM {source})
"""


def fact(source, condition="TRUE", users="users", vehicles="vehicles"):
    return f"""
SELECT t.rental_id, t.user_id, t.vehicle_id, t.rental_start_time, t.rental_end_time,
       date_diff('day', t.rental_start_time, t.rental_end_time) AS rental_duration_days,
       t.pickup_location, t.dropoff_location, t.total_amount
FROM {source} t JOIN {users} u ON t.user_id = u.user_id JOIN {vehicles} v ON t.vehicle_id = v.vehicle_id
JOIN locations lp ON t.pickup_location = lp.location_id
JOIN locations ld ON t.dropoff_location = ld.location_id
WHERE {condition}
"""


WIDE = """
SELECT t.rental_id, t.user_id, u.first_name, u.last_name, u.full_name, u.email, u.phone_number,
       u.driver_license_number, u.driver_license_expiry, u.creation_date, u.age_account,
       u.age_account_segment, u.is_active, u.update_at, t.vehicle_id, v.active,
       v.vehicle_license_number, v.registration_name, v.license_type, v.expiration_date,
       v.permit_license_number, v.certification_date, v.vehicle_year, v.base_telephone_number,
       v.base_address, v.last_update_timestamp AS vehicle_last_update_timestamp,
       v.brand AS vehicle_brand, v.vehicle_type, v.age_vehicle, v.age_vehicle_segment,
       t.rental_start_time, t.rental_end_time, t.rental_duration_days,
       CAST(year(t.rental_end_time) AS BIGINT) AS rental_year,
       CAST(month(t.rental_end_time) AS BIGINT) AS rental_month,
       CAST(day(t.rental_end_time) AS BIGINT) AS rental_day,
       CAST(dayofweek(t.rental_end_time) + 1 AS BIGINT) AS rental_dayofweek,
       dayofweek(t.rental_end_time) IN (0, 6) AS is_weekend,
       t.pickup_location AS pickup_location_id, lp.location_name AS pickup_location_name,
       lp.address AS pickup_address, lp.city AS pickup_city, lp.state AS pickup_state,
       lp.zip_code AS pickup_zip_code, lp.latitude AS pickup_latitude,
       lp.longitude AS pickup_longitude, t.dropoff_location AS dropoff_location_id,
       ld.location_name AS dropoff_location_name, ld.address AS dropoff_address,
       ld.city AS dropoff_city, ld.state AS dropoff_state, ld.zip_code AS dropoff_zip_code,
       ld.latitude AS dropoff_latitude, ld.longitude AS dropoff_longitude, t.total_amount
FROM fact t JOIN users u ON t.user_id = u.user_id JOIN vehicles v ON t.vehicle_id = v.vehicle_id
JOIN locations lp ON t.pickup_location = lp.location_id
JOIN locations ld ON t.dropoff_location = ld.location_id
"""

# The exact sum of doubles: amounts in units of 2**-60 are whole, and the sum is rounded once.
UNITS = "sum(CAST(total_amount * 1152921504606846976 AS HUGEINT))"
MONEY = f"""((CAST({UNITS} // 281474976710656 AS DOUBLE) * 281474976710656
        + CAST({UNITS} % 281474976710656 AS DOUBLE)) / 1152921504606846976)"""

CTES = {
    "raw_locations": RAW_LOCATIONS,
    "raw_users": raw_users(),
    "raw_vehicles": raw_vehicles(),
    "raw_transactions": RAW_TRANSACTIONS,
    "clean_locations": CLEAN_LOCATIONS,
    "locations": LOCATIONS,
    "clean_users": clean_users("raw_users"),
    "clean_vehicles": clean_vehicles(casted_vehicles("raw_vehicles")),
    "rentals": clean_rentals("raw_transactions"),
    "users": dim_users("clean_users"),
    "vehicles": dim_vehicles("clean_vehicles"),
    "fact": fact("rentals"),
    "wide": WIDE,
}
LOCATION_PART = ["raw_locations", "clean_locations", "locations"]
USER_PART = ["raw_users", "clean_users", "users"]
VEHICLE_PART = ["raw_vehicles", "clean_vehicles", "vehicles"]
DIMENSIONS = LOCATION_PART + USER_PART + VEHICLE_PART
FACT_PART = DIMENSIONS + ["raw_transactions", "rentals", "fact"]
ALL = FACT_PART + ["wide"]


def query(names, body, extra=None):
    parts = {**{n: CTES[n] for n in names}, **(extra or {})}
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in parts.items()) + "\n" + body


def favourites(key, attributes):
    """``{output: input}``: row_number over the frequency of each attribute, one join each."""
    joins, columns = "", ""
    for i, (out, column) in enumerate(attributes.items()):
        joins += f"""
LEFT JOIN (SELECT {key}, {column}, row_number() OVER (
               PARTITION BY {key} ORDER BY count(*) DESC, {column} ASC NULLS LAST) AS rn
           FROM wide GROUP BY {key}, {column}) f{i} ON k.{key} = f{i}.{key} AND f{i}.rn = 1"""
        columns += f", f{i}.{column} AS {out}"
    return f"SELECT k.{key}{columns} FROM (SELECT DISTINCT {key} FROM wide) k{joins}"


USER_FAVOURITES = favourites("user_id", {
    "most_used_vehicle_id": "vehicle_id", "most_used_vehicle_brand": "vehicle_brand",
    "most_used_vehicle_type": "vehicle_type", "most_used_pickup_city": "pickup_city",
    "most_used_dropoff_city": "dropoff_city",
})
VEHICLE_FAVOURITES = favourites("vehicle_id", {
    "most_frequent_pickup_city": "pickup_city", "most_frequent_dropoff_city": "dropoff_city",
    "most_frequent_user_id": "user_id",
})


def measures(total, average, highest, lowest):
    return f"""{MONEY} AS {total}, {MONEY} / count(total_amount) AS {average},
       max(total_amount) AS {highest}, min(total_amount) AS {lowest}"""


def days(total, average):
    return f"""CAST(sum(rental_duration_days) AS BIGINT) AS {total},
       avg(rental_duration_days) AS {average}"""


USERS_SUMMARY = f"""
SELECT s.*, f.* EXCLUDE (user_id) FROM (
  SELECT user_id, any_value(full_name) AS full_name, any_value(age_account) AS age_account,
         any_value(age_account_segment) AS age_account_segment, any_value(is_active) AS is_active,
         count(*) AS total_transactions,
         {measures('total_spending', 'average_spending', 'max_spending', 'min_spending')},
         min(rental_start_time) AS first_transaction_date,
         max(rental_start_time) AS last_transaction_date,
         {days('total_rental_days', 'avg_rental_duration_days')}
  FROM wide GROUP BY user_id) s
LEFT JOIN ({USER_FAVOURITES}) f ON s.user_id = f.user_id
"""

VEHICLES_SUMMARY = f"""
SELECT s.*, f.* EXCLUDE (vehicle_id), u.full_name AS most_frequent_user_name FROM (
  SELECT vehicle_id, any_value(vehicle_license_number) AS vehicle_license_number,
         any_value(active) AS active, any_value(vehicle_brand) AS vehicle_brand,
         any_value(vehicle_type) AS vehicle_type, any_value(age_vehicle) AS age_vehicle,
         any_value(age_vehicle_segment) AS age_vehicle_segment, count(*) AS total_transactions,
         {measures('total_revenue', 'average_revenue', 'max_revenue', 'min_revenue')},
         min(rental_start_time) AS first_rented, max(rental_start_time) AS last_rented,
         {days('total_days_rented', 'avg_days_rented')}
  FROM wide GROUP BY vehicle_id) s
LEFT JOIN ({VEHICLE_FAVOURITES}) f ON s.vehicle_id = f.vehicle_id
LEFT JOIN users u ON f.most_frequent_user_id = u.user_id
"""

DAILY_PERFORMANCE = f"""
SELECT rental_year, rental_month, rental_day,
       max(CAST(rental_end_time AS DATE)) AS rental_date, count(*) AS total_transactions,
       count(DISTINCT user_id) AS unique_users, count(DISTINCT vehicle_id) AS unique_vehicles,
       {measures('total_spent', 'avg_spent', 'max_spent', 'min_spent')},
       {days('total_rental_days', 'avg_rental_duration_days')},
       count(DISTINCT pickup_city) AS unique_pickup_cities,
       count(DISTINCT dropoff_city) AS unique_dropoff_cities
FROM wide GROUP BY rental_year, rental_month, rental_day
"""


def daily_top(key, labels, count_name):
    chosen = ", ".join(f"any_value({c}) AS {c}" for c in labels)
    return f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, rank() OVER (PARTITION BY rental_date ORDER BY {count_name} DESC) AS place
  FROM (SELECT CAST(rental_end_time AS DATE) AS rental_date, {key}, {chosen},
               count(*) AS {count_name}
        FROM wide GROUP BY CAST(rental_end_time AS DATE), {key})
) WHERE place = 1
"""


TOP_USERS = daily_top("user_id", ["full_name"], "transactions_per_user")
TOP_VEHICLES = daily_top(
    "vehicle_id", ["vehicle_brand", "vehicle_type"], "transactions_per_vehicle")
TOP_ENTITIES = f"""
SELECT u.rental_date, u.top_users, v.top_vehicles
FROM (SELECT rental_date, list(struct_pack(user_id := user_id, full_name := full_name,
          transactions_per_user := transactions_per_user) ORDER BY user_id) AS top_users
      FROM ({TOP_USERS}) GROUP BY rental_date) u
JOIN (SELECT rental_date, list(struct_pack(vehicle_id := vehicle_id,
          vehicle_brand := vehicle_brand, vehicle_type := vehicle_type,
          transactions_per_vehicle := transactions_per_vehicle) ORDER BY vehicle_id) AS top_vehicles
      FROM ({TOP_VEHICLES}) GROUP BY rental_date) v
ON u.rental_date = v.rental_date
ORDER BY u.rental_date
"""

# Histories: closed and open versions of the first delivery, then new versions.

SECOND_USERS = f"""
SELECT * REPLACE (
  CASE WHEN segment = 'BUILDING' THEN 1 - is_active ELSE is_active END AS is_active,
  CASE WHEN segment = 'BUILDING' THEN {AS_OF} ELSE update_at END AS update_at,
  CASE WHEN segment = 'MACHINERY' THEN creation_date + 5 ELSE creation_date END AS creation_date)
FROM raw_users WHERE segment <> 'FURNITURE'
"""
SECOND_VEHICLES = """
SELECT * REPLACE (
  CASE WHEN vehicle_year < 1992 THEN 0 ELSE active END AS active,
  CASE WHEN vehicle_year < 1992 THEN '01-01-2002 00:00:00' ELSE last_update_timestamp END
    AS last_update_timestamp,
  CASE WHEN vehicle_type = 'LARGE' THEN certification_date + 5 ELSE certification_date END
    AS certification_date)
FROM raw_vehicles WHERE vehicle_type <> 'SMALL'
"""
SEEN = ["TIMESTAMP '2001-12-31 00:00:00'", "TIMESTAMP '2002-01-01 00:00:00'"]


def stamps(alias, key, seen, until):
    return f"""md5({alias}.{key} || '|' || CAST({seen} AS VARCHAR)) AS scd_id,
       {seen} AS scd_updated_at, {seen} AS valid_from, {until} AS valid_to"""


def two_versions(key, columns, seen=SEEN):
    changed = "(" + " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in columns) + ")"
    closing = f"CASE WHEN n.{key} IS NOT NULL AND {changed} THEN {seen[1]} END"
    nothing = "CAST(NULL AS TIMESTAMP)"
    return f"""
SELECT o.*, {stamps('o', key, seen[0], closing)} FROM old_rows o LEFT JOIN new_rows n ON o.{key} = n.{key}
UNION ALL BY NAME
SELECT n.*, {stamps('n', key, seen[1], nothing)} FROM new_rows n LEFT JOIN old_rows o ON o.{key} = n.{key}
WHERE o.{key} IS NULL OR {changed}
"""


USER_STEPS = {
    "first_users": "SELECT * FROM raw_users WHERE segment <> 'HOUSEHOLD'",
    "second_users": SECOND_USERS,
    "old_rows": clean_users("first_users"),
    "new_rows": clean_users("second_users"),
}
VEHICLE_STEPS = {
    "second_vehicles": SECOND_VEHICLES,
    "old_rows": clean_vehicles(
        casted_vehicles("(SELECT * FROM raw_vehicles WHERE vehicle_type <> 'ECONOMY')")),
    "new_rows": clean_vehicles(casted_vehicles("second_vehicles")),
}

CLOSED_FORM = """
SELECT user_id, event_type, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
FROM (SELECT *, row_number() OVER w AS n, lag(event_type) OVER w AS before
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE n = 1 OR event_type IS DISTINCT FROM before
"""


def merged(state, batch):
    return f"""
SELECT * FROM {state} WHERE rental_id NOT IN (SELECT rental_id FROM {batch})
UNION ALL SELECT * FROM {batch}
"""


def above(state):
    return f"rental_end_time > (SELECT max(rental_end_time) FROM {state})"


CUT = "rental_end_time <= TIMESTAMP '2000-01-01'"
TWO_LOADS = {
    "state1": clean_rentals("raw_transactions", CUT),
    "batch2": clean_rentals("raw_transactions", above("state1")),
    "state2": merged("state1", "batch2"),
}
TWO_FACTS = {
    **TWO_LOADS,
    "fact1": fact("state1"),
    "factbatch2": fact("state2", "t." + above("fact1")),
}

USERS_IN = "update_at >= DATE '{0}' AND update_at < DATE '{1}'"
VEHICLES_IN = (
    "CAST(strptime(last_update_timestamp, '%d-%m-%Y %H:%M:%S') AS DATE) >= DATE '{0}' "
    "AND CAST(strptime(last_update_timestamp, '%d-%m-%Y %H:%M:%S') AS DATE) < DATE '{1}'"
)
RENTALS_IN = "CAST(rental_end_time AS DATE) >= DATE '{0}' AND CAST(rental_end_time AS DATE) < DATE '{1}'"
WINDOW = ("1997-01-01", "1999-07-01")


BORDERS = ["1990-01-01", "1998-01-01", "2000-01-01", "2002-01-01"]
RUNS = list(zip(range(1, 4), BORDERS, BORDERS[1:]))


def three_days():
    """Clean rentals and fact after each of three windows."""
    parts = {}
    for d, low, high in RUNS:
        seen_users = USERS_IN.format(BORDERS[0], high)
        seen_vehicles = VEHICLES_IN.format(BORDERS[0], high)
        parts[f"u{d}"] = f"SELECT DISTINCT user_id FROM raw_users WHERE {seen_users}"
        parts[f"v{d}"] = f"SELECT DISTINCT vehicle_id FROM raw_vehicles WHERE {seen_vehicles}"
        parts[f"w{d}"] = "SELECT * FROM raw_transactions WHERE " + RENTALS_IN.format(low, high)
        if d == 1:
            parts["c1"] = clean_rentals("w1")
            parts["f1"] = fact("c1", users="u1", vehicles="v1")
            continue
        parts[f"b{d}"] = clean_rentals(f"w{d}", above(f"c{d - 1}"))
        parts[f"c{d}"] = merged(f"c{d - 1}", f"b{d}")
        parts[f"g{d}"] = fact(f"c{d}", "t." + above(f"f{d - 1}"), f"u{d}", f"v{d}")
        parts[f"f{d}"] = merged(f"f{d - 1}", f"g{d}")
    return parts


def three_days_left_out():
    """After each window, what the fact did not take of the rentals above its mark."""
    parts = three_days()
    for d, _, _ in RUNS:
        fresh = "SELECT * FROM c1" if d == 1 else f"SELECT t.* FROM c{d} t WHERE t." + above(f"f{d - 1}")
        parts[f"n{d}"] = fresh
        out = (QUARANTINE.replace("FROM rentals t", f"FROM n{d} t")
               .replace("FROM vehicles)", f"FROM v{d} WHERE vehicle_id IS NOT NULL)")
               .replace("FROM users)", f"FROM u{d} WHERE user_id IS NOT NULL)"))
        before = "" if d == 1 else f"""
UNION ALL SELECT * FROM l{d - 1} WHERE rental_id NOT IN (SELECT rental_id FROM n{d})"""
        parts[f"l{d}"] = out + before
    return parts


def three_days_of_users():
    parts, versions = {}, []
    for d, low, high in RUNS:
        parts[f"window{d}"] = "SELECT * FROM raw_users WHERE " + USERS_IN.format(low, high)
        parts[f"day{d}"] = clean_users(f"window{d}")
        versions.append(f"SELECT *, TIMESTAMP '{high} 00:00:00' AS valid_from FROM day{d}")
    return parts, " UNION ALL ".join(versions)


DAYS_OF_USERS, USER_VERSIONS = three_days_of_users()
USER_VERSIONS = f"""
SELECT *, valid_from AS scd_updated_at,
       md5(user_id || '|' || CAST(valid_from AS VARCHAR)) AS scd_id,
       lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to
FROM ({USER_VERSIONS})
"""



def accounting():
    """Counts of each window's rows; none of them is late, since every window begins after the last mark."""
    parts, counts = {**three_days_left_out(), **three_days_of_marts()}, []
    undated = {"users": "update_at", "vehicles": "last_update_timestamp", "transactions": "rental_end_time"}
    for d, _, high in RUNS:
        windows = [
            ("users", f"window{d}", "user_id", f"day{d}"), ("vehicles", f"vehicles_in{d}", "vehicle_id", f"vehicles_of{d}"),
            ("transactions", f"w{d}", "rental_id", "c1" if d == 1 else f"b{d}")]
        for source, window, key, taken in windows:
            rows, keyed, kept = f"(SELECT count(*) FROM {window})", f"(SELECT count({key}) FROM {window})", f"(SELECT count(*) FROM {taken})"
            found = {"landed": rows, "keyless": f"{rows} - {keyed}", "late": "0", "duplicate": f"{keyed} - {kept}", "taken": kept,
                     "undated": f"(SELECT count(*) - count({undated[source]}) FROM raw_{source})"}
            counts += [(high, source, o, n) for o, n in found.items()]
        fresh, got = f"(SELECT count(*) FROM n{d})", f"(SELECT count(*) FROM {'f1' if d == 1 else f'g{d}'})"
        counts += [(high, "clean_transactions", "fact", got), (high, "clean_transactions", "left_out", f"{fresh} - {got}")]
    body = " UNION ALL ".join(
        f"SELECT DATE '{h}' AS window_end, '{s}' AS source, '{o}' AS outcome, CAST({n} AS BIGINT) AS rows" for h, s, o, n in counts)
    return query(LOCATION_PART + ["raw_users", "raw_vehicles", "raw_transactions"], body, parts)


def three_days_of_marts():
    """The star after the windows, under the names that the marts' SQL reads."""
    parts, versions = {**three_days(), **DAYS_OF_USERS}, []
    for d, low, high in RUNS:
        parts[f"vehicles_in{d}"] = "SELECT * FROM raw_vehicles WHERE " + VEHICLES_IN.format(low, high)
        parts[f"vehicles_of{d}"] = clean_vehicles(casted_vehicles(f"vehicles_in{d}"))
        versions.append(f"SELECT *, TIMESTAMP '{high} 00:00:00' AS valid_from FROM vehicles_of{d}")
    newest = "SELECT * FROM ({0}) QUALIFY row_number() OVER (PARTITION BY {1} ORDER BY valid_from DESC) = 1"
    parts["known_users"] = newest.format(USER_VERSIONS, "user_id")
    parts["known_vehicles"] = newest.format(" UNION ALL ".join(versions), "vehicle_id")
    parts["users"] = dim_users("known_users")
    parts["vehicles"] = (
        "SELECT * EXCLUDE (valid_from) FROM (" + dim_vehicles("known_vehicles") + ")")
    return {**parts, "fact": "SELECT * FROM f3", "wide": WIDE}


QUARANTINE = """
SELECT * FROM (
  SELECT t.*, concat_ws(',',
    CASE WHEN pickup_location NOT IN (SELECT location_id FROM locations) THEN 'pickup_location' END,
    CASE WHEN dropoff_location NOT IN (SELECT location_id FROM locations) THEN 'dropoff_location' END,
    CASE WHEN vehicle_id NOT IN (SELECT vehicle_id FROM vehicles) THEN 'vehicle_id' END,
    CASE WHEN user_id NOT IN (SELECT user_id FROM users) THEN 'user_id' END) AS missing_references
  FROM rentals t)
WHERE missing_references <> ''
"""

KEYED_UPDATE = f"""
SELECT r.* REPLACE (
  CASE WHEN due.user_id IS NOT NULL THEN 0 ELSE r.is_active END AS is_active,
  CASE WHEN due.user_id IS NOT NULL THEN {AS_OF} ELSE r.update_at END AS update_at)
FROM (SELECT * EXCLUDE (segment) FROM raw_users) r
LEFT JOIN (SELECT DISTINCT user_id FROM raw_users
           WHERE creation_date < DATE '1996-01-01' AND is_active = 1) due
ON r.user_id = due.user_id
"""

RAW_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}"
    for t in ["users", "vehicles", "transactions", "locations"])
PENDING = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t} WHERE {c.format(*WINDOW)}"
    for t, c in [("users", USERS_IN), ("vehicles", VEHICLES_IN), ("transactions", RENTALS_IN)])

# The columns and types of the two source tables that are profiled.
USER_TYPES = [
    ("user_id", "string"), ("first_name", "string"), ("last_name", "string"),
    ("email", "string"), ("phone_number", "string"), ("driver_license_number", "string"),
    ("driver_license_expiry", "date"), ("creation_date", "date"), ("is_active", "int"),
    ("update_at", "date"),
]
VEHICLE_COLUMNS = [
    "active", "vehicle_license_number", "registration_name", "license_type",
    "expiration_date", "permit_license_number", "certification_date", "vehicle_year",
    "base_telephone_number", "base_address", "vehicle_id", "last_update_timestamp", "brand",
    "vehicle_type",
]
COLUMN_SUMMARY = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS position, '{t}' AS data_type, "
    f"count({c}) AS non_null_count FROM raw_users" for i, (c, t) in enumerate(USER_TYPES))
NULL_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM raw_vehicles"
    for c in VEHICLE_COLUMNS)


def duplicates(columns):
    return f"""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count
FROM (SELECT count(*) AS n FROM raw_transactions GROUP BY {columns})"""


RAW_VEHICLES, RAW_USERS = ["raw_vehicles"], ["raw_users"]

ORACLES = {
    "clean_users": query(RAW_USERS + ["clean_users"], "SELECT * FROM clean_users"),
    "casted_vehicles": query(RAW_VEHICLES, casted_vehicles("raw_vehicles")),
    "clean_vehicles": query(RAW_VEHICLES + ["clean_vehicles"], "SELECT * FROM clean_vehicles"),
    "clean_locations": query(LOCATION_PART[:2], "SELECT * FROM clean_locations"),
    "location_enrichment": query(LOCATION_PART, "SELECT * FROM locations"),
    "dim_locations": query(LOCATION_PART, "SELECT * FROM locations"),
    "epoch_nanos_to_datetime": query(["raw_transactions"], """
SELECT rental_id, epoch_us(rental_end_time) * 1000 AS rental_end_nanos,
       make_timestamp(epoch_us(rental_end_time)) AS rental_end_time FROM raw_transactions"""),
    "clean_transactions_full": query(["raw_transactions", "rentals"], "SELECT * FROM rentals"),
    "clean_transactions_incremental": query(
        ["raw_transactions"], "SELECT * FROM state2", TWO_LOADS),
    "fact_incremental": query(
        DIMENSIONS + ["raw_transactions"], merged("fact1", "factbatch2"), TWO_FACTS),
    "keyed_update_users": query(RAW_USERS, KEYED_UPDATE),
    "scd2_users_two_batches": query(
        RAW_USERS, two_versions("user_id", USER_CHECK_COLUMNS), USER_STEPS),
    "scd2_vehicles_two_batches": query(
        RAW_VEHICLES, two_versions("vehicle_id", VEHICLE_CHECK_COLUMNS), VEHICLE_STEPS),
    "current_users_after_two_batches": query(
        RAW_USERS, dim_users("(SELECT * FROM history WHERE valid_to IS NULL)"),
        {**USER_STEPS, "history": two_versions("user_id", USER_CHECK_COLUMNS)}),
    "scd2_history_closed_form": CLOSED_FORM,
    "dim_users": query(USER_PART, "SELECT * FROM users"),
    "dim_vehicles": query(VEHICLE_PART, "SELECT * FROM vehicles"),
    "fact_transactions": query(FACT_PART, "SELECT * FROM fact"),
    "fact_quarantine": query(FACT_PART, QUARANTINE),
    "denormalized_transactions": query(ALL, "SELECT * FROM wide"),
    "weekend_split": query(
        ALL, "SELECT is_weekend, count(*) AS total_transactions FROM wide GROUP BY is_weekend"),
    "user_favourites": query(ALL, USER_FAVOURITES),
    "vehicle_favourites": query(ALL, VEHICLE_FAVOURITES),
    "users_summary": query(ALL, USERS_SUMMARY),
    "vehicles_summary": query(ALL, VEHICLES_SUMMARY),
    "daily_performance": query(ALL, DAILY_PERFORMANCE),
    "daily_top_users": query(ALL, TOP_USERS),
    "daily_top_vehicles": query(ALL, TOP_VEHICLES),
    "daily_top_entities": query(ALL, TOP_ENTITIES),
    "window_extract_users": query(
        RAW_USERS,
        "SELECT * EXCLUDE (segment) FROM raw_users WHERE " + USERS_IN.format(*WINDOW)),
    "window_extract_vehicles": query(
        RAW_VEHICLES, "SELECT * FROM raw_vehicles WHERE " + VEHICLES_IN.format(*WINDOW)),
    "window_extract_transactions": query(
        ["raw_transactions"],
        "SELECT * FROM raw_transactions WHERE " + RENTALS_IN.format(*WINDOW)),
    "parquet_extract_roundtrip": query(
        ["raw_transactions"],
        "SELECT * FROM raw_transactions WHERE " + RENTALS_IN.format(*WINDOW)),
    "csv_roundtrip": query(["raw_transactions"], "SELECT * FROM raw_transactions"),
    "pending_window_counts": query(["raw_users", "raw_vehicles", "raw_transactions"], PENDING),
    "business_dates": """
SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS business_date, count(*) AS events
FROM events GROUP BY 1""",
    "profile_row_counts": query(
        ["raw_users", "raw_vehicles", "raw_transactions", "raw_locations"], RAW_COUNTS),
    "profile_columns": query(RAW_USERS, COLUMN_SUMMARY),
    "profile_null_counts": query(RAW_VEHICLES, NULL_COUNTS),
    "profile_duplicate_keys": query(["raw_transactions"], duplicates("rental_id")),
    "profile_duplicate_rows": query(
        ["raw_transactions"], duplicates(
            "rental_id, user_id, vehicle_id, rental_start_time, rental_end_time, "
            "pickup_location, dropoff_location, total_amount")),
    "profile_value_counts": query(RAW_VEHICLES, """
SELECT brand, count(*) AS count FROM raw_vehicles WHERE brand IS NOT NULL
GROUP BY brand ORDER BY count DESC, brand"""),
    "peek_latest_rentals": query(
        ["raw_transactions", "rentals"],
        "SELECT * FROM rentals ORDER BY rental_end_time DESC, rental_id LIMIT 3"),
    "dangling_new_ids": query(RAW_USERS, """
SELECT DISTINCT user_id FROM raw_users WHERE user_id IS NOT NULL AND segment <> 'FURNITURE'
AND user_id NOT IN (SELECT user_id FROM raw_users
                    WHERE user_id IS NOT NULL AND segment <> 'HOUSEHOLD')"""),
    "run_day_fact": query(
        LOCATION_PART + ["raw_users", "raw_vehicles", "raw_transactions"], "SELECT * FROM f3",
        three_days()),
    "run_day_quarantine": query(
        LOCATION_PART + ["raw_users", "raw_vehicles", "raw_transactions"], "SELECT * FROM l3",
        three_days_left_out()),
    "daily_user_history": query(RAW_USERS, USER_VERSIONS, DAYS_OF_USERS),
    "rentals_as_of_user": query(RAW_USERS + ["raw_transactions", "rentals"], """
SELECT r.rental_id, r.user_id, r.rental_end_time, v.is_active, v.update_at, v.valid_from, v.valid_to
FROM rentals r ASOF LEFT JOIN versions v ON r.user_id = v.user_id AND r.rental_end_time >= v.valid_from""",
        {**DAYS_OF_USERS, "versions": USER_VERSIONS}),
}
ORACLES["run_day_accounting"] = accounting()
ORACLES |= {
    f"run_day_{name}": query(
        LOCATION_PART + ["raw_users", "raw_vehicles", "raw_transactions"], body, three_days_of_marts())
    for name, body in {
        "dim_users": "SELECT * FROM users", "dim_vehicles": "SELECT * FROM vehicles",
        "users_summary": USERS_SUMMARY, "vehicles_summary": VEHICLES_SUMMARY,
        "daily_performance": DAILY_PERFORMANCE, "daily_top_entities": TOP_ENTITIES,
    }.items()
}
