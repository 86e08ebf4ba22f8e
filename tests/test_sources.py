import datetime as dt
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from motorpool import schemas
from motorpool.plans import staging
from motorpool.session import CLEANUP, shared_dir, shuffles_dropped
from motorpool.sources import (
    PartitionedState, StartDate, Warehouse, create_layers, day_slices, land_extract, load_raw,
    read_csv, recreate_table, write_csv,
)

from .conftest import executed_plan, rows_of

T = dt.datetime


def rentals(spark, rows):
    return spark.createDataFrame(rows, schemas.TRANSACTIONS)


def rental(key, end, amount=1.0):
    return (key, "u", "v", end - dt.timedelta(hours=1), end, "1", "2", amount)


def test_csv_round_trip_with_quotes_and_nulls(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 'smith, "jones" and co', None, "modesto", "ca", 94540, 86.25802, -169.2448)],
        schemas.LOCATIONS)
    write_csv(rows, str(tmp_path / "loc"))
    assert rows_of(read_csv(spark, str(tmp_path / "loc"), "locations")) == rows_of(rows)

    timed = rentals(spark, [rental("r", T(2025, 7, 5, 10, 20, 30))])
    write_csv(timed.coalesce(1), str(tmp_path / "rentals"))
    assert "2025-07-05 10:20:30" in next((tmp_path / "rentals").glob("part*")).read_text()
    assert rows_of(read_csv(spark, str(tmp_path / "rentals"), "transactions")) == rows_of(timed)


def test_csv_that_does_not_fit_the_schema_raises(spark, tmp_path):
    header = "location_id,location_name,address,city,state,zip_code,latitude,longitude\n"
    (tmp_path / "bad.csv").write_text(header + "x,a,b,c,d,1,1.0,1.0\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, str(tmp_path / "bad.csv"), "locations").collect()
    (tmp_path / "head.csv").write_text("id" + header[11:] + "1,a,b,c,d,1,1.0,1.0\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "head.csv"), "locations").collect()


def test_extract_is_dated_and_repeatable(spark, tmp_path):
    rows = rentals(spark, [rental("r", T(2025, 7, 5))])
    for _ in range(2):
        path = land_extract(rows, str(tmp_path), "transactions", dt.date(2025, 7, 5))
    assert path.endswith("/transactions/extract_date=2025-07-05")
    assert rows_of(load_raw(spark, path)) == rows_of(rows)
    assert rows_of(load_raw(spark, path, str(tmp_path / "raw"))) == rows_of(rows)


def test_raw_datetimes_in_nanoseconds(spark, tmp_path):
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    times = [T(2025, 7, 5, 10, 0, 0, 123456), None]
    table = pa.table({
        "rental_id": ["a", "b"], "user_id": ["u", "u"], "vehicle_id": ["v", "v"],
        "rental_start_time": pa.array(times, pa.timestamp("ns")),
        "rental_end_time": pa.array(times, pa.timestamp("ns")),
        "pickup_location": ["1", "1"], "dropoff_location": ["2", "2"], "total_amount": [1.0, 2.0],
    })
    pq.write_table(table, tmp_path / "raw.parquet", version="2.6")
    raw = load_raw(spark, str(tmp_path / "raw.parquet"))
    assert dict(raw.dtypes)["rental_end_time"] == "bigint"
    clean = staging.clean_transactions(raw)
    assert rows_of(clean.select("rental_id", "rental_end_time")) == [("a", times[0]), ("b", None)]


def test_day_slices_cover_the_window():
    slices = day_slices("update_at", dt.date(2025, 2, 28), dt.date(2025, 3, 2))
    assert slices == [
        "update_at >= '2025-02-28' AND update_at < '2025-03-01'",
        "update_at >= '2025-03-01' AND update_at < '2025-03-02'",
    ]


def test_start_date_is_the_last_written(spark, tmp_path):
    control = StartDate(spark, str(tmp_path / "control"))
    control.set(dt.date(2025, 7, 6), T(2025, 7, 6))
    control.set(dt.date(2025, 7, 1), T(2025, 7, 7))  # set back by hand
    assert control.get() == dt.date(2025, 7, 1)


# Partitioned state.

def months(spark, root):
    label = F.coalesce(F.date_format("rental_end_time", "yyyy-MM"), F.lit("undated"))
    return PartitionedState(spark, str(root), label)


def files(root):
    return {p.relative_to(root) for p in root.glob("data/gen=*/part=*")}


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    state = months(spark, tmp_path)
    assert state.read() is None and not state.exists()
    state.merge(rentals(spark, [
        rental("a", T(2025, 1, 5)), rental("b", T(2025, 2, 5)), rental("c", T(2025, 3, 5)),
        rental("d", T(2025, 1, 6))]), ["rental_id"])
    before = files(tmp_path)
    assert state.partitions() == ["2025-01", "2025-02", "2025-03"]

    # "a" moves to April, "b" leaves February empty, "e" is new.
    state.merge(rentals(spark, [
        rental("a", T(2025, 4, 5), 9.0), rental("b", T(2025, 4, 6), 9.0), rental("e", T(2025, 4, 7))
    ]), ["rental_id"])
    state = months(spark, tmp_path)
    assert state.partitions() == ["2025-01", "2025-03", "2025-04"]
    assert {str(f) for f in files(tmp_path) - before} == {
        "data/gen=1/part=2025-01", "data/gen=1/part=2025-04"}
    found = rows_of(state.read().select("rental_id", "rental_end_time", "total_amount"))
    assert found == sorted([
        ("a", T(2025, 4, 5), 9.0), ("b", T(2025, 4, 6), 9.0), ("c", T(2025, 3, 5), 1.0),
        ("d", T(2025, 1, 6), 1.0), ("e", T(2025, 4, 7), 1.0)], key=repr)
    assert state.read(["2025-01"]).count() == 1
    assert state.read([]).schema == state.read().schema


def numbered(spark, numbers, day):
    return rentals(spark, [rental(f"r{i}", T(2025, 1 + i % 9, day)) for i in numbers])


def test_a_merge_reads_only_the_key_buckets_that_its_batch_hits(spark, tmp_path):
    state = months(spark, tmp_path)
    state.merge(numbered(spark, range(300), 1), ["rental_id"])
    state = months(spark, tmp_path)
    assert state.keys_from == 0
    batch = numbered(spark, [7, 1000], 2)
    found = state.index.hit(batch, ["rental_id"], state.keys_from, state.generation)
    buckets = {r["b"] for r in batch.select(F.pmod(F.xxhash64("rental_id"), F.lit(64)).alias("b")).collect()}
    (scan,) = [line for line in executed_plan(found).splitlines() if "FileScan" in line]
    assert "hash" in scan and "rental_id" not in scan  # the state itself is not read
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in filters and all(str(b) in filters for b in buckets)
    assert state._holding(batch, ["rental_id"]) == {"2025-08"}
    # Read are one file of entries for each bucket that is hit and was written.
    there = state.index._entries(0, 0).where(F.col("bucket").isin(list(buckets)))
    assert there.select("bucket").distinct().count() <= 2


def test_the_key_index_follows_moved_rows_and_is_folded(spark, tmp_path):
    state = months(spark, tmp_path)
    state.index.folded = 3
    state.merge(numbered(spark, range(20), 1), ["rental_id"])
    for month in range(2, 9):  # r3 moves on, one new rental each time
        state = months(spark, tmp_path)
        state.index.folded = 3
        state.merge(rentals(spark, [rental("r3", T(2025, month, 9)), rental(f"n{month}", T(2025, month, 9))]), ["rental_id"])
        assert state._holding(numbered(spark, [3], 1), ["rental_id"]) == {f"2025-{month:02}"}
        assert state.generation - state.keys_from <= 3
    state = months(spark, tmp_path)
    assert state.keys_from > 0
    assert state.read().count() == state.read().select("rental_id").distinct().count() == 27
    ids = numbered(spark, range(20), 1)
    by_scan = state.parts_of(state.read().join(ids.select("rental_id"), "rental_id", "left_semi"))
    assert state._holding(ids, ["rental_id"]) == by_scan


def test_a_table_without_key_index_is_scanned_once_and_then_has_one(spark, tmp_path):
    state = months(spark, tmp_path)
    state.commit(numbered(spark, range(9), 1))
    assert months(spark, tmp_path).keys_from is None
    state = months(spark, tmp_path)
    state.merge(rentals(spark, [rental("r2", T(2025, 9, 9))]), ["rental_id"])
    state = months(spark, tmp_path)
    assert state.keys_from == 1
    assert state._holding(numbered(spark, [2, 4], 1), ["rental_id"]) == {"2025-05", "2025-09"}
    # A run that died left entries of a generation that no list names: they do not count.
    state.index.add(rentals(spark, [rental("r4", T(2025, 1, 9))]), ["rental_id"], state.part, 1, 2)
    assert months(spark, tmp_path)._holding(numbered(spark, [4], 1), ["rental_id"]) == {"2025-05"}


def test_replace_takes_out_keys_that_do_not_come_back(spark, tmp_path):
    state = months(spark, tmp_path)
    state.merge(numbered(spark, range(9), 1), ["rental_id"])
    gone = state.staged(numbered(spark, [1, 2, 77], 5))
    state.replace(state.staged(numbered(spark, [2], 5), "rows"), gone, ["rental_id"])
    kept = rows_of(months(spark, tmp_path).read().select("rental_id", "rental_end_time"))
    assert kept == sorted([(f"r{i}", T(2025, 1 + i, 5 if i == 2 else 1)) for i in range(9) if i != 1], key=repr)


def test_a_run_that_dies_before_the_list_leaves_the_old_table(spark, tmp_path):
    state = months(spark, tmp_path)
    state.merge(rentals(spark, [rental("a", T(2025, 1, 5))]), ["rental_id"])
    # Data of the next generation without its list, as a killed run leaves it.
    rentals(spark, [rental("z", T(2025, 1, 5)), rental("y", T(2025, 9, 5))]).withColumn(
        "part", F.lit("2025-01")).write.partitionBy("part").parquet(str(tmp_path / "data/gen=1"))
    state = months(spark, tmp_path)
    assert [r["rental_id"] for r in state.read().collect()] == ["a"]
    state.merge(rentals(spark, [rental("b", T(2025, 1, 7))]), ["rental_id"])
    assert rows_of(months(spark, tmp_path).read().select("rental_id")) == [("a",), ("b",)]


def test_empty_batches_and_rows_without_date(spark, tmp_path):
    state = months(spark, tmp_path)
    none = rentals(spark, [])
    state.merge(none, ["rental_id"])
    state = months(spark, tmp_path)
    assert state.exists() and state.read().count() == 0
    state.merge(rentals(spark, [("n", "u", "v", None, None, "1", "2", 1.0)]), ["rental_id"])
    state.merge(none, ["rental_id"])
    assert months(spark, tmp_path).partitions() == ["undated"]


def test_rows_outside_the_touched_partitions_are_refused(spark, tmp_path):
    state = months(spark, tmp_path)
    with pytest.raises(ValueError):
        state.commit(rentals(spark, [rental("a", T(2025, 1, 5))]), ["2025-02"])
    assert not months(spark, tmp_path).exists()


# Layers and kinds.

def test_layers_and_typed_tables(spark):
    create_layers(spark)
    create_layers(spark)
    names = {d.name for d in spark.catalog.listDatabases()}
    assert set(schemas.LAYERS.values()) <= names
    for _ in range(2):
        recreate_table(spark, "staging_dataset.raw_users", schemas.USERS)
    table = spark.table("staging_dataset.raw_users")
    assert table.schema == schemas.USERS and table.count() == 0


def test_kinds(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.range(3)
    warehouse.materialize("denormalized_transactions", "view", rows)
    assert spark.table("denormalized_transactions").count() == 3
    for n in (3, 2):
        written = warehouse.materialize("dim_users", "table", spark.range(n))
        assert written.count() == n
    assert (tmp_path / "reporting_dataset" / "dim_users").exists()
    with pytest.raises(ValueError):
        warehouse.materialize("dim_users", "other", rows)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def shuffle_files(spark):
    """Files of shuffles that this session holds."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (blocks.apply(i).getName() for i in range(blocks.size())) if f.startswith("shuffle_")}


def test_shuffles_of_a_finished_query_are_dropped(spark, tmp_path):
    before = shuffle_files(spark)
    setting = spark.conf.get(CLEANUP)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_dropped(spark):
        rows.select("k", "count").write.parquet(str(tmp_path / "counted"))
    assert spark.conf.get(CLEANUP) == setting
    for _ in range(50):  # they are removed beside the query
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert spark.read.parquet(str(tmp_path / "counted")).agg(F.sum("count")).first()[0] == 1000


def test_a_derived_table_is_written_when_its_sources_or_columns_change(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))

    def written(rows, built_from):
        found = rows_of(warehouse.materialize("dim_users", "table", rows, built_from))
        return found, warehouse.generation("dim_users")

    two, three = [(0,), (1,)], [(0,), (1,), (2,)]
    assert warehouse.generation("dim_users") is None
    assert written(spark.range(2), "a") == (two, 0)
    assert written(spark.range(2), "a") == (two, 0)
    assert written(spark.range(3), "b") == (three, 1)
    assert written(spark.range(3).toDF("other"), "b") == (three, 2)
    # Without a word on its sources it is always written.
    assert written(spark.range(2), None) == (two, 3)
    assert written(spark.range(2), None) == (two, 4)


def test_a_list_written_before_tables_said_what_they_were_built_from(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.materialize("dim_users", "table", spark.range(2), "a")
    path = f"{warehouse.path('dim_users')}/live/gen=0"
    entries = spark.read.parquet(path).drop("built_from")
    spark.createDataFrame(entries.collect(), entries.schema).write.mode("overwrite").parquet(path)
    assert rows_of(warehouse.table("dim_users")) == [(0,), (1,)]
    warehouse.materialize("dim_users", "table", spark.range(3), "a")
    assert warehouse.generation("dim_users") == 1
