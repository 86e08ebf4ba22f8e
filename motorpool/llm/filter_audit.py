"""How corpus filters interact: what each removes, and what that depends on, in every order of them.

Every document is told by one mask, a bit for each filter that it fails, so that documents fall into
cells of part and mask with a count, a count of good and a count of toxic ones. A cell folds over the
array of all orders: transform goes through the orders and, in each, through the steps, an aggregate
over the filters before the step tells whether the cell still is there, and each step becomes a struct
weighted by the cell's counts. The structs of a part's cells (120 orders of 5 steps: 600) are
added element by element; a last fold over them sums a filter's removals over all orders.

Texts move as digests only. Copies are found by grouping on the digest with the number of rows and the
least doc_id, so a text of a third of all rows is one row a map task; labels are joined by doc_id.

Results in special cases: a null text is empty; a null lang, like an empty one, is part ''. Rows that
repeat a doc_id all count, each with its own text; among equal texts those of the least doc_id are no
copies. A row without doc_id has no labels, is a copy of nothing, and nothing is a copy of it. Several labels of
a doc_id count as good or toxic if any is; null marks are neither. An empty table gives no rows.
Other columns of the input are not read.
"""

from itertools import permutations

from pyspark.sql import Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITAL_PERCENT = 10
SYMBOLS = "#$%&*|"
SUMS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _own_failures():
    """The filters that look at one text alone, as bits in the order of FILTERS."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    fails = [
        n < LEAST_WORDS,
        distinct * 100 < n * LEAST_DISTINCT_PERCENT,
        capitals * 100 > F.char_length(text) * MOST_CAPITAL_PERCENT,
        text.rlike(f"[{SYMBOLS}]"),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def _labelled(docs, labels):
    """(doc_id, part, mask, digest, good, toxic, n): equal rows counted, with the labels of doc_id."""
    told = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), _own_failures().alias("mask"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    told = told.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # Rows without doc_id meet no label; their digest spreads them over the tasks of the join.
    left = told.withColumn("lone", F.when(F.col("doc_id").isNull(), F.col("digest")).otherwise(""))
    right = marks.withColumn("lone", F.lit(""))
    key = [left.doc_id.eqNullSafe(right.doc_id), left.lone == right.lone]
    return left.join(right, key, "left").select(
        left.doc_id, "part", "mask", "digest", "n",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def cells(docs, labels):
    """(part, mask, n, good, toxic): all documents by the filters they fail, the last bit for copies."""
    known = F.col("doc_id").isNotNull()
    groups = _labelled(docs, labels).groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n"))).alias("known"),
        F.min(F.when(known, F.struct("doc_id", "part", "n"))).alias("first"))
    # A digest has at most a row for each part and pair of labels here, however many copies there are.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    copies = F.coalesce(F.col("known"), F.lit(0)) - F.coalesce(firsts, F.lit(0))
    bit = 1 << FILTERS.index("E")
    told = groups.select("part", "mask", "good", "toxic", "n", copies.alias("copies")).select(
        "part", "good", "toxic", F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
            F.struct((F.col("mask") + bit).alias("mask"), F.col("copies").alias("n")))))
    return told.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def _fails(mask, filter_number):
    return F.get(F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda b: F.call_function(
        "getbit", mask, b) == 1), filter_number)


def _folded(orders):
    """A cell's structs, one for each step of each order, weighted by its counts."""
    mask, n, good, toxic = (F.col(c) for c in ("mask", "n", "good", "toxic"))
    nothing = F.lit(0).cast("bigint")

    def step(order, place):
        now = F.get(order, place)
        earlier = F.aggregate(F.slice(order, F.lit(1), place), F.lit(False), lambda gone, f: gone | _fails(mask, f))
        fails = _fails(mask, now)
        here, alone = fails & ~earlier, F.bit_count(mask) == 1
        weigh = lambda told, weight: F.when(told, weight).otherwise(nothing)
        return F.struct(
            weigh(~fails & ~earlier, n).alias("kept"), weigh(here, n).alias("removed"),
            weigh(fails & earlier, n).alias("redundant"), weigh(fails & alone, n).alias("unique_fails"),
            weigh(here, good).alias("good_lost"), weigh(here, toxic).alias("toxic_lost"))

    steps = F.sequence(F.lit(0), F.lit(len(FILTERS) - 1))
    return F.flatten(F.transform(orders, lambda order: F.transform(steps, lambda place: step(order, place))))


def _merged(told, size):
    """The structs of all cells of a group, added element by element."""
    zero = F.array_repeat(F.struct(*(F.lit(0).cast("bigint").alias(s) for s in SUMS)), size)
    return F.aggregate(F.collect_list(told), zero, lambda total, one: F.zip_with(
        total, one, lambda a, b: F.struct(*((a[s] + b[s]).alias(s) for s in SUMS))))


def audit(docs, labels):
    """(part, filter_order, step, SUMS..., shapley) from docs (doc_id, text, lang) and labels (doc_id,
    quality, toxic): one row for each part, order of the filters and step in it."""
    every = list(permutations(range(len(FILTERS))))
    orders = F.array(*(F.array(*(F.lit(f) for f in order)) for order in every))
    size = len(every) * len(FILTERS)
    folded = cells(docs, labels).select("part", _folded(orders).alias("told"))
    # At most one row for each mask in a part.
    merged = folded.groupBy("part").agg(_merged(F.col("told"), size).alias("told"))
    flat = F.flatten(orders)
    by_filter = F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda f: F.aggregate(
        F.zip_with(flat, F.col("told"), lambda now, one: F.when(now == f, one["removed"]).otherwise(0)),
        F.lit(0).cast("bigint"), lambda total, one: total + one))
    rows = merged.select("part", "told", by_filter.alias("by_filter")).select(
        "part", "by_filter", F.posexplode("told").alias("at", "one"))
    place = F.col("at") % len(FILTERS)
    order = F.get(orders, (F.col("at") / len(FILTERS)).cast("int"))
    letter = lambda f: F.substring(F.lit(FILTERS), f + 1, F.lit(1))
    return rows.select(
        "part", F.concat_ws("", F.transform(order, letter)).alias("filter_order"),
        (place + 1).cast("int").alias("step"), *(F.col(f"one.{s}").alias(s) for s in SUMS),
        F.get("by_filter", F.get(order, place)).alias("shapley"))
