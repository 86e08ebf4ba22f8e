"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Documents with the same shingle set form a class, joined before anything is compared. The signature
of a class gives one key per band. First every class is paired with one class, the least of most of
its buckets; the pairs are confirmed on the full shingle sets and make the first groups. Then every
class of a bucket is paired with the bucket's least class where the two aren't in one group by now, so
a family of near copies is compared about once a class, not once a class and band. A bucket that
still spans several groups afterwards is searched on: each class outside the bucket's largest group is compared by
sketch with the next 3 classes of the bucket, then with its blocks of 64 classes, nearest first, until
the bucket is one group or all blocks have been compared. Only what passes becomes a pair, in the
bucket of the first band that the two share. (Passed over are pairs whose sizes
differ too much; whose parity maps, 2048 bits for each set, differ in more bits than linked sets differ
in elements, which rules a link out exactly; or whose signatures differ in so many slots that a link is
out of the question, 4.5 standard errors of SuperMinHash.) So no link that any band finds is lost, and a group of copies costs a pair each.

With 40 bands of 6 rows a pair of similarity 0.8 shares a band with probability 1 - 5e-6, a pair of
0.9 with all but certainty; unrelated documents (similarity 0.05) meet with probability 6e-7.

Results in special cases: a text that is null, empty or without words has no shingles, links with
nothing and stands alone. A null doc_id has a null component and is kept. Rows that repeat a doc_id
are one document to the links of all of its texts. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from .components import ROWS_SENT, components, joined, sent_whole
from .shared import pieces, saved
from .shingles import linked, shingle_sets
from .superminhash import band_keys, parity_maps, signatures, sketches, variance_factor
from .words import mix, text_list

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 40, 6
_BLOCK_BYTES = 2_000_000
#: Classes of a bucket that an outside class is compared with at a time.
_RING_BLOCK = 64
#: Stored rows of a few numbers, and pairs of texts, that a task is given at least: small tables don't leave
#: a file of a few bytes for each shuffle partition, and the shuffles that read them neither.
_TASK_ROWS, _TASK_PAIRS = 100_000, 1000
#: Classes with their signatures (some 600 bytes each) that are sent to all tasks.
_DRAWN_SENT = 20_000
#: Bits of a set's parity map; a longer one tells larger sets apart.
PARITY_BITS = 2048
_PLACED = (
    "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, "
    "bands array<bigint>, sketch array<bigint>, parity array<bigint>")


def _stored(df, most):
    """The same rows, of which there are so many at most, stored in no more parts than they fill."""
    return saved(df.coalesce(pieces(most, _TASK_ROWS)))


def _blocks(batches, limit=_BLOCK_BYTES):
    """Runs of (ids, texts) of a bounded size; a text above it is a run of its own."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch["doc_id"].to_pylist(), text_list(batch["text"]), strict=True):
            if held and held + len(t) > limit:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(t)
            held += len(t)
    if ids:
        yield ids, texts


def _sum_hashes(sets, seed):
    return np.array([mix(s ^ np.uint64(seed)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)


def _place(size, bands, rows):
    def place(batches):
        for ids, texts in _blocks(batches):
            sets = shingle_sets(texts, size)
            signature = signatures(sets, bands * rows)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
                for x in (band_keys(signature, bands), sketches(signature), parity_maps(sets, PARITY_BITS))]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(_sum_hashes(sets, 1)), pa.array(_sum_hashes(sets, 2)), *lists,
            ], names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch", "parity"])
    return place


def _confirm(size, percent):
    def confirm(batches):
        for batch in batches:
            both = sum(pc.binary_length(batch[c]).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("text_u", "text_v"))
            cuts = np.flatnonzero(np.diff(np.cumsum(both) // _BLOCK_BYTES, prepend=-1) > 0)
            for first, end in zip(cuts, [*cuts[1:], len(both)], strict=True):
                part = batch.slice(first, end - first)
                coded = part["text_u"].dictionary_encode()  # many rows share one text_u
                a, at = shingle_sets(text_list(coded.dictionary), size), coded.indices.to_numpy()
                b = shingle_sets(text_list(part["text_v"]), size)
                keep = pa.array([linked(a[i], y, percent) for i, y in zip(at, b, strict=True)], pa.bool_())
                yield part.select(["u", "v"]).filter(keep)
    return confirm


def confirmed(docs, pairs, size, percent):
    """The pairs (u, v) of doc_ids whose whole texts are linked. Each text moves once per partner;
    texts without one stay where they are while the ids of the others are few enough to send."""
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    asked = pairs.count()
    if asked == 0:
        return pairs.select("u", "v")
    pairs = pairs.coalesce(pieces(asked, _TASK_ROWS))
    needed = _stored(
        pairs.select(F.col("u").alias("doc_id")).distinct().unionByName(pairs.select(F.col("v").alias("doc_id")).distinct()).distinct(),
        2 * asked)
    if needed.count() <= ROWS_SENT:
        texts = texts.join(F.broadcast(needed), "doc_id", "left_semi")
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u")), "u")
        .join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v")), "v")
        .select("u", "v", "text_u", "text_v"))
    return both.coalesce(pieces(asked, _TASK_PAIRS)).mapInArrow(_confirm(size, percent), "u bigint, v bigint")


def _most_shared(members):
    """Each class with the class that is the least of most of its buckets."""
    often = members.where("class > least").groupBy("class", "least").agg(F.count("*").alias("n"))
    best = often.groupBy("class").agg(F.min(F.struct(-F.col("n"), "least")).alias("best"))
    return best.select(F.col("best.least").alias("u"), F.col("class").alias("v"))


def _with_least(still):
    """Each class of an open bucket with the bucket's least class, where their groups differ."""
    least = still.groupBy("bucket").agg(F.min(F.struct("class", "grp")).alias("least"))
    apart = still.join(least, "bucket").where("grp <> least.grp")
    return apart.select(F.col("least.class").alias("u"), F.col("class").alias("v")).distinct()


def _open_buckets(members, groups):
    """The members of buckets that still span several groups, each with its group."""
    placed = (
        members.join(sent_whole(groups), members["class"] == groups["node"], "left")
        .select("bucket", "class", F.coalesce("component", "class").alias("grp")))
    split = placed.groupBy("bucket").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a < b")
    return placed.join(split.select("bucket"), "bucket", "left_semi")


def _ranked(still):
    """Open members by place in their bucket, with the bucket's length and its home: a class of the
    group that is the largest now. Groups only merge, so what is at home once stays there."""
    sizes = still.groupBy("bucket", "grp").agg(F.count("*").alias("of_group"), F.min("class").alias("first"))
    homes = sizes.groupBy("bucket").agg(
        F.max_by("first", F.struct("of_group", "grp")).alias("home"), F.sum("of_group").cast("int").alias("n"))
    places = F.row_number().over(Window.partitionBy("bucket").orderBy("class"))
    return still.select("bucket", "class", places.alias("place")).join(homes, "bucket")


def _outside(ranked, groups, n):
    """(all n members with their present group, those that are not in the group of their bucket's home)."""
    rows = _stored(
        ranked.join(sent_whole(groups), ranked["class"] == groups["node"], "left")
        .select(*ranked.columns, F.coalesce("component", "class").alias("grp")), n)
    homes = rows.where(F.col("class") == F.col("home")).select("bucket", F.col("grp").alias("home_grp"))
    return rows, _stored(rows.join(homes, "bucket").where("grp <> home_grp").drop("home_grp"), n)


def _far(slots, percent):
    """SQL: sizes that rule a link out; parity maps that do, exactly: linked sets differ in at most
    (size_a + size_b) * (100 - percent) / (100 + percent) elements; and, for sets too large for the
    maps, sketches (a, b) that differ in more slots than a linked pair's do, by more than 4.5
    standard errors."""
    unlike = 1 - percent / 100
    shown = unlike * 15 / 16  # differing slots differ in their four bits 15 times of 16

    def most(union):
        spread = variance_factor(slots, union) * unlike * (percent / 100) * (15 / 16) ** 2 + unlike * 15 / 256
        return slots * shown + 4.5 * (slots * spread) ** 0.5

    # Small sets have the smaller variance; a linked pair's union is at most (size_a + size_b) / 1.8.
    whole = 1 + percent / 100
    cases = " ".join(f"WHEN size_a + size_b <= {int(u * whole)} THEN {most(u):.1f}" for u in (slots // 2, slots, 2 * slots, 4 * slots))
    limit = f"CASE {cases} ELSE {slots * shown + 4.5 * (slots * shown * (1 - shown)) ** 0.5:.1f} END"
    fold = "(a[{i}] ^ b[{i}])"
    differ = " + ".join(
        "bit_count((" + " | ".join(
            [fold.format(i=i), *(f"shiftrightunsigned({fold.format(i=i)}, {k})" for k in (1, 2, 3))]
        ) + f") & {0x1111111111111111})"
        for i in range(-(-slots // 16)))
    apart = " + ".join(f"bit_count(parity_a[{i}] ^ parity_b[{i}])" for i in range(PARITY_BITS // 64))
    return (
        f"100 * least(size_a, size_b) < {percent} * greatest(size_a, size_b) "
        f"OR {100 + percent} * ({apart}) > {100 - percent} * (size_a + size_b) OR ({differ}) > {limit}")


def _same_first(bands):
    """SQL: the bucket is that of the first band in which both classes (keys_a, keys_b) agree, so a
    pair that meets in many buckets is made in one."""
    cases = " ".join(f"WHEN keys_a[{i}] = keys_b[{i}] THEN keys_a[{i}]" for i in range(bands))
    return f"CASE {cases} END = CAST(in_bucket & {2**31 - 1} AS INT)"


def _named(rows, drawn, end):
    """Members with sketch, size and band keys of their class, named for one end of a pair."""
    names = {"sketch": end, "n_shingles": f"size_{end}", "keys": f"keys_{end}", "parity": f"parity_{end}"}
    return rows.join(drawn, "class").withColumnsRenamed(names)


def _near_places(rows, outside, drawn, last, far):
    """Pairs of an outside class and one of the next places of the bucket's ring."""
    ahead = _named(outside, drawn, "a").where("n > 1").select(
        F.col("bucket").alias("in_bucket"), F.explode(F.sequence(F.lit(1), F.least(F.lit(last), F.col("n") - 1))).alias("step"),
        F.col("place").alias("from"), F.col("n").alias("ring"), F.col("class").alias("u"), F.col("grp").alias("g"), "a", "size_a", "parity_a")
    ahead = ahead.withColumn("at", (F.col("from") + F.col("step") - 1) % F.col("ring") + 1)
    meet = (F.col("in_bucket") == F.col("bucket")) & (F.col("at") == F.col("place")) & (F.col("g") != F.col("grp"))
    return ahead.join(_named(rows, drawn, "b"), meet & ~F.expr(far))


def _near_blocks(rows, outside, drawn, first, last, far, bands):
    """Pairs of an outside class and the members of the blocks first..last further on in the ring.
    Two outside classes meet from the side with fewer blocks between them."""
    block = lambda place: F.floor((F.col(place) - 1) / _RING_BLOCK).cast("int")
    ahead = _named(outside, drawn, "a").withColumn("ring", block("n") + 1).where(F.col("ring") > first).select(
        F.col("bucket").alias("in_bucket"),
        F.explode(F.sequence(F.lit(first), F.least(F.lit(last), F.col("ring") - 1))).alias("step"),
        block("place").alias("from"), "ring", F.col("class").alias("u"), F.col("grp").alias("g"), "a", "size_a", "keys_a", "parity_a")
    ahead = ahead.withColumn("at", (F.col("from") + F.col("step")) % F.col("ring"))
    apart = outside.select(F.col("bucket").alias("out_bucket"), F.col("class").alias("out_class"))
    there = rows.join(apart, (F.col("bucket") == F.col("out_bucket")) & (F.col("class") == F.col("out_class")), "left")
    there = _named(there.withColumn("is_out", F.col("out_class").isNotNull()).drop("out_bucket", "out_class"), drawn, "b")
    there = there.withColumn("block", block("place"))
    meet = (F.col("in_bucket") == F.col("bucket")) & (F.col("at") == F.col("block")) & (F.col("g") != F.col("grp"))
    once = F.expr(
        "NOT is_out OR (step > 0 AND 2 * step < ring) OR ((step = 0 OR 2 * step = ring) AND u < class)")
    # The band test first: it is short, and leaves a pair of several common bands one comparison of maps.
    return ahead.join(there, meet & once & F.expr(_same_first(bands)) & ~F.expr(far))


def near_duplicates(docs, size=SHINGLE_WORDS, percent=PERCENT, bands=BANDS, rows=ROWS):
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id bigint, text)."""
    docs = docs.select("doc_id", "text")
    placed = saved(docs.mapInArrow(_place(size, bands, rows), _PLACED))
    n_docs = placed.count()
    member = ["set_a", "set_b"]
    known = placed.where("doc_id IS NOT NULL AND n_shingles > 0")
    ids = known.groupBy(*member).agg(F.min("doc_id").alias("class"))
    in_class = _stored(known.select("doc_id", *member).join(ids, member), n_docs)
    repeated = in_class.groupBy("doc_id").agg(F.min("class").alias("u"), F.collect_set("class").alias("all"))
    repeated = repeated.where(F.size("all") > 1).select("u", F.explode("all").alias("v"))

    # One row of bands per class, from the row of its least document.
    least = in_class.where("doc_id = class").distinct()
    leaders = known.join(least, [*member, "doc_id"])
    keyed = leaders.select("class", F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    members = _stored(keyed.join(shared.where("least < most").select("bucket", "least"), "bucket"), n_docs * bands)
    tested = _stored(_most_shared(members), n_docs)
    links = saved(confirmed(docs, tested, size, percent).unionByName(repeated.select("u", "v").coalesce(pieces(n_docs, _TASK_ROWS))))
    groups = saved(components(links))

    still = _stored(_open_buckets(members, groups), n_docs * bands)
    n = still.count()
    if n:
        pairs = _stored(_with_least(still).join(tested, ["u", "v"], "left_anti"), n)
        tested = tested.unionByName(pairs)
        groups = joined(groups, saved(confirmed(docs, pairs, size, percent)))
        still = _stored(_open_buckets(still.select("bucket", "class"), groups), n)
        n = still.count()
    if n:
        open_classes = _stored(still.select("class").distinct(), n)
        n_drawn = open_classes.count()
        drawn = known.join(sent_whole(open_classes), known["doc_id"] == open_classes["class"], "left_semi")
        drawn = _stored(
            drawn.join(least, [*member, "doc_id"])
            .select(
                "class", "sketch", "n_shingles", "parity",
                F.transform("bands", lambda key: key.bitwiseAND(F.lit(2**31 - 1)).cast("int")).alias("keys"))
            .dropDuplicates(["class"]), n_drawn)
        drawn = sent_whole(drawn, _DRAWN_SENT)
        ranked = _stored(_ranked(still), n)
        blocks = ranked.agg(F.max("n")).first()[0] // _RING_BLOCK + 1
        far = _far(bands * rows, percent)
        rows_now, outside = _outside(ranked, groups, n)
        # The nearest places first, then blocks in growing steps: groups merge before most pairs are due.
        rounds, first = [None], 0
        while first < blocks:
            rounds.append((first, 16 * first + 15))
            first = 16 * first + 16
        for due in rounds:
            made = (
                _near_places(rows_now, outside, drawn, 3, far) if due is None
                else _near_blocks(rows_now, outside, drawn, *due, far, bands))
            made = made.select(F.least("u", "class").alias("u"), F.greatest("u", "class").alias("v")).distinct()
            pairs = saved(made.join(tested, ["u", "v"], "left_anti"))
            pairs = pairs.coalesce(pieces(pairs.count(), _TASK_ROWS))
            tested = tested.unionByName(pairs)
            more = saved(confirmed(docs, pairs, size, percent))
            if not more.isEmpty():
                groups = joined(groups, more)
                rows_now, outside = _outside(ranked, groups, n)
                if outside.isEmpty():
                    break

    found = (
        in_class.join(sent_whole(groups), in_class["class"] == groups["node"], "left")
        .select("doc_id", *member, F.coalesce("component", "class").alias("component_id")).distinct())
    result = placed.join(found, ["doc_id", *member], "left")
    component = F.coalesce("component_id", "doc_id")
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
