import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from motorpool.operators import (
    above_mark, column_summary, current_versions, dedup_latest, duplicate_count,
    history_from_changes, integrity_quarantine, integrity_valid, keyed_update, lookup_join,
    merge_upsert, mode_by, new_keys, null_counts, peek, pending_counts, row_counts, scd2_step,
    top_per_group, value_counts, window_filter,
)
from motorpool.operators.joins import HOT_SHARE, broadcastable, hot_key_splits

from .conftest import executed_plan, rows_of

D = dt.date
T = dt.datetime


# Deduplication.

def test_dedup_keeps_the_latest_and_is_independent_of_order(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "q"), ("b", 0, "r"),
            ("c", None, None), ("c", None, "s")]
    for order in (rows, rows[::-1]):
        kept = dedup_latest(spark.createDataFrame(order, "k string, t int, v string"), ["k"], ["t"])
        assert rows_of(kept) == [("a", 3, "y"), ("b", 0, "r"), ("c", None, "s")]


def test_dedup_cuts_every_map_partition_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("if(id < 990, 'hot', 'cold') AS k", "id AS t")
    kept = dedup_latest(rows, ["k"], ["t"])
    plan = executed_plan(kept)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")
    assert rows_of(kept) == [("cold", 999), ("hot", 989)]


# Joins.

def skewed(spark):
    """A third of the rows on one key, a fifth without key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 97))
    return spark.range(30000).select("id", key.alias("k"))


def lookup(spark):
    named = [("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 97, 2)] + [("unused", "u")]
    return spark.createDataFrame(named, "k string, v string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_the_plain_join(spark, no_broadcast, how):
    rows, table = skewed(spark), lookup(spark)
    assert broadcastable(table) is None
    split = lookup_join(rows, table, "k", ["id"], how)
    plain = rows.join(table, "k", how)
    assert split.columns == plain.columns
    assert split.exceptAll(plain).count() == 0
    assert plain.exceptAll(split).count() == 0


def test_hot_keys_are_found_and_their_pieces_bounded(spark):
    splits = dict(hot_key_splits(skewed(spark), "k"))
    assert splits["hot"] > 0.3 / HOT_SHARE
    assert sum(splits.values()) <= 2 / HOT_SHARE


def test_hot_rows_are_dealt_over_many_partitions(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(skewed(spark), lookup(spark), "k", ["id"])
        hot = joined.where(F.col("k") == "hot").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in hot.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)


def test_small_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in executed_plan(lookup_join(skewed(spark), lookup(spark), "k", ["id"]))


def test_a_wild_estimate_is_measured(spark):
    wide = lookup(spark).join(spark.range(200000), F.length("k") == F.col("id")).select("k", "v")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "20KB")
    try:
        assert broadcastable(wide) is not None
        assert broadcastable(skewed(spark)) is None
    finally:
        spark.conf.unset(limit)


@pytest.mark.parametrize("broadcast", [True, False])
def test_integrity_splits_the_rows_in_two(spark, broadcast):
    rows = spark.createDataFrame(
        [(1, "u1", "v1"), (2, "u9", "v1"), (3, "u9", "v9"), (4, None, "v1"), (5, "u2", "v2")],
        "id int, u string, v string")
    users = spark.createDataFrame([("u1",), ("u2",), ("u2",)], "user string")
    vehicles = spark.createDataFrame([("v1",), ("v2",)], "vehicle string")
    references = [("u", users, "user"), ("v", vehicles, "vehicle")]
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        valid = rows_of(integrity_valid(rows, references, ["id"]).select("id"))
        bad = rows_of(integrity_quarantine(rows, references, ["id"])
                      .select("id", F.array_join("missing_references", ",")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert valid == [(1,), (5,)]  # the repeated user does not multiply row 5
    assert bad == [(2, "u"), (3, "u,v"), (4, "u")]


def test_new_keys(spark):
    old = spark.createDataFrame([("a",), ("b",)], "k string")
    candidates = old.unionByName(spark.createDataFrame([("c",), ("c",)], "k string"))
    assert rows_of(new_keys(candidates, old, "k")) == [("c",)]


# Mark, merge, update.

def test_mark_is_strict_and_an_empty_state_sets_none(spark):
    batch = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "k int, t int")
    state = spark.createDataFrame([(9, 5), (8, None)], "k int, t int")
    assert rows_of(above_mark(batch, state, "t")) == [(2, 6)]
    for nothing in (None, state.limit(0), state.where("t IS NULL")):
        assert above_mark(batch, nothing, "t").count() == 3


def test_merge_replaces_adds_and_can_be_repeated(spark):
    state = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([("B", 2), (None, 3)], "v string, k int")
    once = merge_upsert(state, batch, ["k"])
    assert rows_of(once) == [(1, "a"), (2, "B"), (3, None)]
    assert rows_of(merge_upsert(once, batch, ["k"])) == rows_of(once)
    assert merge_upsert(None, batch, ["k"]) is batch


def test_keyed_update_writes_nulls_and_ignores_other_keys(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "y"), (None, 1, "z")], "k string, n int, s string")
    updates = spark.createDataFrame([("a", None, 9), ("q", 5, 5)], "k string, n int, extra int")
    updated = keyed_update(rows, updates, "k", ["n"])
    assert updated.columns == rows.columns
    assert rows_of(updated) == rows_of(spark.createDataFrame(
        [("a", None, "x"), ("a", None, "x"), ("b", 1, "y"), (None, 1, "z")], rows.schema))


# Histories.

HISTORY = "k string, a int, b string, other int"
DAY1, DAY2, DAY3 = T(2025, 1, 1), T(2025, 1, 2), T(2025, 1, 3)


def versions(history):
    return rows_of(history.select("k", "a", "b", "other", "valid_from", "valid_to"))


def test_scd2_steps(spark):
    first = spark.createDataFrame(
        [("same", 1, None, 0), ("changed", 1, "x", 0), ("to_null", 1, "x", 0),
         ("swapped", 1, None, 0), ("unwatched", 1, "x", 0), ("absent", 1, "x", 0),
         ("nothing", None, None, 0)], HISTORY)
    second = spark.createDataFrame(
        [("same", 1, None, 0), ("changed", 2, "x", 0), ("to_null", None, "x", 0),
         ("swapped", None, "1", 0), ("unwatched", 1, "x", 7), ("new", 1, "x", 0),
         ("nothing", None, None, 0)], HISTORY)
    history = scd2_step(scd2_step(None, first, "k", ["a", "b"], DAY1), second, "k", ["a", "b"], DAY2)
    closed = {"changed", "to_null", "swapped"}
    expected = [(*r, DAY1, DAY2 if r[0] in closed else None) for r in map(tuple, first.collect())]
    expected += [(*r, DAY2, None) for r in map(tuple, second.collect()) if r[0] in closed | {"new"}]
    assert versions(history) == sorted(expected, key=repr)
    assert current_versions(history).count() == 8
    assert history.select("scd_id").distinct().count() == history.count()

    repeated = scd2_step(history, second, "k", ["a", "b"], DAY3)
    assert versions(repeated) == versions(history)
    assert versions(scd2_step(history, second.limit(0), "k", ["a", "b"], DAY3)) == versions(history)


def test_scd2_small_batch_does_not_shuffle_the_open_versions(spark, tmp_path):
    rows = spark.range(1000).select(
        F.col("id").cast("string").alias("k"), F.lit(1).alias("a"), F.lit("x").alias("b"),
        F.lit(0).alias("other"))
    scd2_step(None, rows, "k", ["a"], DAY1).write.parquet(str(tmp_path / "history"))
    rows.limit(3).withColumn("a", F.lit(2)).write.parquet(str(tmp_path / "batch"))
    history, batch = (spark.read.parquet(str(tmp_path / n)) for n in ["history", "batch"])
    stepped = scd2_step(history, batch, "k", ["a"], DAY2)
    assert "SortMergeJoin" not in executed_plan(stepped)
    assert stepped.count() == 1003


def test_folding_steps_equals_the_closed_form(spark):
    rng = random.Random(3)
    log = [(f"k{key}", DAY1 + dt.timedelta(days=day), rng.choice([None, 1, 2]), rng.choice([None, "x"]))
           for key in range(12) for day in range(6) if rng.random() < 0.7]
    changes = spark.createDataFrame(log, "k string, t timestamp_ntz, a int, b string")
    history = None
    for moment in sorted({r[1] for r in log}):
        batch = changes.where(F.col("t") == F.lit(str(moment)).cast("timestamp_ntz")).drop("t")
        history = scd2_step(history, batch, "k", ["a", "b"], moment)
        history = spark.createDataFrame(history.collect(), history.schema)
    columns = ["k", "a", "b", "valid_from", "valid_to"]
    whole = history_from_changes(changes, "k", ["t"], ["a", "b"])
    assert rows_of(whole.select(columns)) == rows_of(history.select(columns))

    # Contiguous, at most one open version per key.
    by_key = Window.partitionBy("k").orderBy("valid_from")
    gaps = whole.withColumn("next", F.lead("valid_from").over(by_key)).where(
        ~F.col("valid_to").eqNullSafe(F.col("next")))
    assert gaps.count() == 0


@pytest.mark.parametrize("bucket", [None, "date_trunc('hour', t)", "1"])
def test_closed_form_does_not_depend_on_its_buckets(spark, bucket):
    rng = random.Random(5)
    log = [(rng.choice(["hot", "hot", "a"]), T(2025, 1, 1) + dt.timedelta(minutes=17 * i), i,
            rng.choice([None, "x", "y"])) for i in range(400)]
    changes = spark.createDataFrame(log, "k string, t timestamp_ntz, n int, v string")
    expected = []
    for key in {r[0] for r in log}:
        runs = []
        for _, moment, _, value in sorted((r for r in log if r[0] == key), key=lambda r: r[1]):
            if not runs or runs[-1][1] != value:
                runs.append((moment, value))
        ends = [m for m, _ in runs[1:]] + [None]
        expected += [(key, v, m, e) for (m, v), e in zip(runs, ends)]
    found = history_from_changes(changes, "k", ["t", "n"], ["v"], bucket and F.expr(bucket))
    assert rows_of(found) == sorted(expected, key=repr)


# Frequencies.

def test_mode_by(spark):
    rows = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), ("a", "y", 2), ("a", "y", 1), ("b", None, 5), ("b", None, 7),
         ("b", "z", 7), ("c", None, None), ("c", "q", 3)], "k string, s string, n int")
    found = mode_by(rows, "k", {"top_s": "s", "top_n": "n"})
    assert dict(found.dtypes)["top_n"] == "int"
    assert rows_of(found) == [("a", "x", 1), ("b", None, 7), ("c", "q", 3)]


def test_top_per_group_is_rank_one_and_never_ranks(spark):
    rng = random.Random(11)
    rows = spark.createDataFrame(
        [(D(2025, 1, rng.randint(1, 9)), rng.randint(1, 6)) for _ in range(300)], "day date, k int")
    top = top_per_group(rows, "day", "k", "n")
    by_day = Window.partitionBy("day").orderBy(F.desc("n"))
    ranked = rows.groupBy("day", "k").agg(F.count("*").alias("n")).withColumn(
        "r", F.rank().over(by_day)).where("r = 1").drop("r")
    assert rows_of(top) == rows_of(ranked)
    assert "Window" not in executed_plan(top)


# Profiling and windows.

def test_profile(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, None), (None, "b"), (None, "b")], "n int, s string")
    assert rows_of(row_counts({"t": rows, "empty": rows.limit(0)})) == [("empty", 0), ("t", 5)]
    assert rows_of(null_counts(rows)) == [("n", 2), ("s", 1)]
    assert rows_of(column_summary(rows)) == [("n", 0, "int", 3), ("s", 1, "string", 4)]
    assert duplicate_count(rows, ["n"]).first()[0] == 3
    assert duplicate_count(rows).first()[0] == 2
    assert duplicate_count(rows.limit(0)).first()[0] == 0
    assert [tuple(r) for r in value_counts(rows, "s").collect()] == [("a", 2), ("b", 2)]
    assert [tuple(r) for r in peek(rows, 1, [F.desc("n"), "s"]).collect()] == [(1, None)]


def test_window_is_half_open_and_needs_a_date(spark):
    start, end = D(2025, 7, 5), D(2025, 7, 6)
    dates = spark.createDataFrame([(D(2025, 7, d),) for d in (4, 5, 6)] + [(None,)], "x date")
    times = spark.createDataFrame(
        [(T(2025, 7, 4, 23, 59, 59),), (T(2025, 7, 5),), (T(2025, 7, 5, 23, 59),), (T(2025, 7, 6),)],
        "x timestamp_ntz")
    texts = spark.createDataFrame(
        [("04-07-2025 23:00:00",), ("05-07-2025 00:00:00",), ("05-07-2025",), (None,)], "x string")
    assert [window_filter(t, "x", start, end).count() for t in (dates, times, texts)] == [1, 2, 2]
    assert window_filter(dates, "x", start, start).count() == 0


def test_window_reaches_the_scan(spark, tmp_path):
    times = spark.createDataFrame([(T(2025, 7, 5), 1)], "rental_end_time timestamp_ntz, y int")
    times.write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    plan = executed_plan(window_filter(rows, "rental_end_time", D(2025, 7, 5), D(2025, 7, 6)))
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(rental_end_time" in pushed and "LessThan(" in pushed
    pending = pending_counts({"transactions": rows}, D(2025, 7, 5), D(2025, 7, 6))
    assert rows_of(pending) == [("transactions", 1)]


def test_mode_by_breaks_ties_in_the_order_of_the_type(spark):
    rows = spark.createDataFrame(
        [("a", 10, "x", 1), ("a", 9, "x", 1), ("b", 7, "y", 1), ("b", 100, "z", 3), ("c", None, None, 1)],
        "k string, n bigint, s string, times bigint")
    tops = {"top_n": "n", "top_s": "s"}
    assert rows_of(mode_by(rows, "k", tops)) == sorted(
        [("a", 9, "x"), ("b", 7, "y"), ("c", None, None)], key=repr)
    assert rows_of(mode_by(rows, "k", tops, weight="times")) == sorted(
        [("a", 9, "x"), ("b", 100, "z"), ("c", None, None)], key=repr)


def test_as_of_join_finds_the_version_valid_at_each_time(spark):
    from motorpool.operators import as_of_join

    t = lambda d, h=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h)
    versions = [("a", 1, t(0), t(3)), ("a", 2, t(3), t(5, 6)), ("a", 3, t(9), None), ("b", 4, t(2, 5), None),
                (None, 5, t(0), None), ("c", 6, t(1), t(1)), ("c", 7, t(1), None), ("d", 8, None, None)]
    rng = random.Random(8)
    rows = [(rng.choice(["a", "a", "a", "b", "c", "d", "z", None]), t(rng.randrange(-2, 14), rng.randrange(24)), i)
            for i in range(300)] + [("a", None, 900), ("a", t(3), 901), ("a", t(5, 6), 902), ("a", t(5, 5), 903)]

    def valid(key, at):
        fits = [v for v in versions if key is not None and v[0] == key and at is not None and v[2] is not None
                and v[2] <= at and (v[3] is None or at < v[3])]
        return fits[-1][1:] if fits else (None, None, None)

    history = spark.createDataFrame(versions, "k string, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    asked = spark.createDataFrame(rows, "k string, at timestamp_ntz, id int").repartition(3)
    expected = sorted(((k, at, i, *valid(k, at)) for k, at, i in rows), key=repr)
    for bucket in ("day", "hour", "year"):
        assert rows_of(as_of_join(asked, history, "k", "at", ["v"], bucket)) == expected
    assert rows_of(as_of_join(asked, history.where("1 = 0"), "k", "at", ["v"])) == sorted(
        ((*r, None, None, None) for r in rows), key=repr)


def test_a_hot_day_of_one_key_is_cut_into_pieces(spark):
    from motorpool.operators.history import _cut

    # One key with 6,000 changes on one day, most at the same minute; others with a few each.
    start = dt.datetime(2024, 1, 1)
    log = [("hot", start + dt.timedelta(seconds=i * 7 if i < 3000 else 20_000 + i), i, i // 5 % 3) for i in range(6000)]
    log += [(f"k{i % 7}", start + dt.timedelta(hours=i), i, i % 2) for i in range(60)]
    log += [("hot", start + dt.timedelta(days=1, seconds=i), 9000 + i, 1) for i in range(5)]
    changes = spark.createDataFrame(log, "k string, at timestamp_ntz, id bigint, v bigint").repartition(4)
    whole = history_from_changes(changes, "k", ["at", "id"], ["v"], most=10**9)
    cut = history_from_changes(changes, "k", ["at", "id"], ["v"], most=50)
    assert rows_of(cut) == rows_of(whole)
    assert len(rows_of(cut)) > 1200
    dealt = _cut(changes.withColumn("_bucket", F.col("at").cast("date")), "k", "at", 50)
    sizes = {tuple(r)[:3]: r["count"] for r in dealt.groupBy("k", "_bucket", "_piece").count().collect()}
    hot = [n for (k, day, _), n in sizes.items() if k == "hot" and day == start.date()]
    assert sum(hot) == 6000 and len(hot) > 150 and max(hot) < 100
    assert {piece for (k, _, piece) in sizes if k != "hot"} == {0}


def test_history_from_changes_keeps_unknown_keys_and_times(spark):
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    log = spark.createDataFrame(
        [("a", first, 1, "x"), (None, first, 2, "y"), (None, second, 3, "z"), ("a", None, 4, "w")],
        "k string, at timestamp_ntz, id bigint, v string")
    found = history_from_changes(log, "k", ["at", "id"], ["v"])
    assert rows_of(found) == sorted([
        ("a", "x", first, None), ("a", "w", None, first),
        (None, "y", first, second), (None, "z", second, None)], key=repr)


def test_a_shuffled_join_without_hot_keys_uses_how_the_rows_lie(spark, no_broadcast):
    rows = spark.range(300000).selectExpr("id", "id % 150000 AS k")
    known = spark.range(150000).selectExpr("id AS k")
    named = known.selectExpr("k", "k + 1 AS v")
    met = lookup_join(lookup_join(rows, known, "k", ["id"], "left_semi"), named, "k", ["id"], sample_of=rows)
    plan = executed_plan(met)
    assert "_piece" not in plan
    assert plan.count("Exchange hashpartitioning(k") == 3
    assert met.where("v = k + 1").count() == 300000


def test_mode_by_counts_one_attribute_at_a_time(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, None), ("a", 2, None), (None, 3, "z")], "k string, n int, s string")
    modes = mode_by(rows, "k", {"number": "n", "text": "s"})
    assert "Generate" not in executed_plan(modes)
    assert rows_of(modes) == sorted([("a", 1, None), (None, 3, "z")], key=repr)
