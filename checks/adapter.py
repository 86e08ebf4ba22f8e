"""The driver's tables presented as rental entities.

Messy on purpose: padded mixed-case names, repeated keys, missing keys, text dates,
rentals with dangling locations.
"""

from pyspark.sql import functions as F

AS_OF = "2002-01-01"


# The schemas of the tables read here. Stating them saves a job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def _read(spark, sf_dir, name):
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir):
    return _read(spark, sf_dir, "events")


def locations(spark, sf_dir):
    """25 locations, five to a city, as they are before normalisation."""
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS location_id",
        "concat(' ', n_name, '\t') AS location_name",
        "concat(n_nationkey, ' Main STREET ') AS address",
        "concat('\t', r_name) AS city",
        "'CA ' AS state",
        "n_nationkey + 90000 AS zip_code",
        "n_nationkey * 1.5D AS latitude",
        "n_nationkey * 2.25D - 120D AS longitude",
    )


def _users(spark, sf_dir):
    """Customers; the solvent ones come twice, those of one nation also without a key."""
    return _read(spark, sf_dir, "customer").selectExpr(
        "*",
        "explode(array_compact(array('first', IF(c_acctbal > 5000, 'again', NULL), "
        "IF(c_nationkey = 7, 'keyless', NULL)))) AS copy",
    ).selectExpr(
        "*",
        "date_add(DATE '1995-01-01', CAST(c_custkey * 977 % 2557 + IF(copy = 'again', 1, 0) AS INT))"
        " AS creation_date",
    ).selectExpr(
        "IF(copy <> 'keyless', CAST(c_custkey AS STRING), NULL) AS user_id",
        "concat('  ', upper(split_part(c_name, '#', 1)), '\t') AS first_name",
        "concat('No', split_part(c_name, '#', 2), ' ') AS last_name",
        "concat('user', c_custkey, '@example.org') AS email",
        "concat('555-', c_custkey) AS phone_number",
        "concat('AB', c_custkey) AS driver_license_number",
        "date_add(DATE '2003-01-01', CAST(c_custkey % 1000 AS INT)) AS driver_license_expiry",
        "creation_date",
        "CAST(c_acctbal > 0 AS INT) AS is_active",
        "creation_date AS update_at",
        "c_mktsegment AS segment",
    )


def users(spark, sf_dir):
    return _users(spark, sf_dir).drop("segment")


def vehicles(spark, sf_dir):
    """Parts; small sizes come twice, one brand also without a key."""
    return _read(spark, sf_dir, "part").selectExpr(
        "*",
        "explode(array_compact(array('first', IF(p_size <= 10, 'again', NULL), "
        "IF(p_brand = 'Brand#3', 'keyless', NULL)))) AS copy",
        "date_add(DATE '1990-01-01', p_size * 87) AS certification_date",
    ).selectExpr(
        "CAST(p_size > 10 AS INT) AS active",
        "lpad(CAST(p_partkey AS STRING), greatest(7, length(CAST(p_partkey AS STRING))), '0') AS vehicle_license_number",
        "p_name AS registration_name",
        "IF(p_size > 25, 'FOR HIRE VEHICLE', 'LEASED VEHICLE') AS license_type",
        "date_format(date_add(DATE '2003-01-01', CAST(p_partkey % 900 AS INT)), 'dd-MM-yyyy')"
        " AS expiration_date",
        "concat('P', p_partkey) AS permit_license_number",
        "certification_date",
        "year(certification_date) AS vehicle_year",
        "concat('(555)', p_partkey) AS base_telephone_number",
        "concat(p_name, ' road') AS base_address",
        "IF(copy <> 'keyless', CAST(p_partkey AS STRING), NULL) AS vehicle_id",
        "date_format(timestampadd(MINUTE, IF(copy = 'again', 2000, 600), "
        "CAST(certification_date AS TIMESTAMP_NTZ)), 'dd-MM-yyyy HH:mm:ss')"
        " AS last_update_timestamp",
        "p_brand AS brand",
        "p_type AS vehicle_type",
    )


def transactions(spark, sf_dir):
    """Line items; a quarter of the keys repeat and two of 27 dropoffs do not exist."""
    lineitem = _read(spark, sf_dir, "lineitem")
    # Orders grow with the line items, so they are shuffled at any size.
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("merge")
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).join(
        supplier, lineitem.l_suppkey == supplier.s_suppkey
    )
    return rows.selectExpr(
        "*", "timestampadd(MINUTE, l_orderkey % 1440, l_shipdate) AS rental_end_time"
    ).selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber) AS rental_id",
        "CAST(o_custkey AS STRING) AS user_id",
        "CAST(l_partkey AS STRING) AS vehicle_id",
        "timestampadd(HOUR, -CAST(l_quantity AS BIGINT), rental_end_time) AS rental_start_time",
        "rental_end_time",
        "CAST(s_nationkey AS STRING) AS pickup_location",
        "CAST((l_orderkey + l_linenumber) % 27 AS STRING) AS dropoff_location",
        "l_extendedprice AS total_amount",
    )


# Second deliveries, told apart by a business attribute of the rows.

def user_batches(spark, sf_dir):
    """A first batch without HOUSEHOLD, and a second one in which BUILDING users are
    switched, MACHINERY users have another creation date, FURNITURE users are missing
    and HOUSEHOLD users are new."""
    rows = _users(spark, sf_dir)
    segment = F.col("segment")
    first = rows.where(segment != "HOUSEHOLD")
    second = rows.where(segment != "FURNITURE").withColumns({
        "is_active": F.when(segment == "BUILDING", 1 - F.col("is_active"))
        .otherwise(F.col("is_active")),
        "update_at": F.when(segment == "BUILDING", F.lit(AS_OF).cast("date"))
        .otherwise(F.col("update_at")),
        "creation_date": F.when(segment == "MACHINERY", F.date_add("creation_date", 5))
        .otherwise(F.col("creation_date")),
    })
    return first.drop("segment"), second.drop("segment")


def vehicle_batches(spark, sf_dir):
    """A first batch without ECONOMY, and a second one in which vehicles from before
    1992 are retired, LARGE ones have another certification date, SMALL ones are missing
    and ECONOMY ones are new."""
    rows = vehicles(spark, sf_dir)
    kind, old = F.col("vehicle_type"), F.col("vehicle_year") < 1992
    first = rows.where(kind != "ECONOMY")
    second = rows.where(kind != "SMALL").withColumns({
        "active": F.when(old, 0).otherwise(F.col("active")),
        "last_update_timestamp": F.when(old, "01-01-2002 00:00:00")
        .otherwise(F.col("last_update_timestamp")),
        "certification_date": F.when(kind == "LARGE", F.date_add("certification_date", 5))
        .otherwise(F.col("certification_date")),
    })
    return first, second
