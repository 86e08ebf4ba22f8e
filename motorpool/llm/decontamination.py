"""Benchmark passages in training documents, by a positional inverted index.

Only DataFrame functions. The benchmark's words are the index's terms. The index is written to the
shared folder as one posting (doc_id row, term, place) for each training token that is a term, with
no shuffle: postings stay with their document, so an index part needs no other part. Each window of
13 words of an item is looked up from its rarest term by corpus frequency: its postings, less the
term's offset, give candidate alignments (document, item, shift). For those the postings of the
remaining terms are intersected at the same shift, and runs of window length are phrase matches.
phrase_matches() does this; proximity_matches() returns the shortest stretches of a document that
hold all terms of a short query in any order.

A term table is broadcast while under TERMS_BROADCAST rows; above, the same joins shuffle. Common
terms' postings are read only where a rare term has already put a candidate. Tokens of a text are
never regrouped by term, so a frequent term makes no hot key; alignments of one document are grouped
by document, their number bounded by its length times the items that repeat a phrase.

Results in special cases: a null or empty text and one without words has no tokens and no hits; so
has everything where the benchmark is empty. Rows that repeat a doc_id are judged one by one, a null
doc_id too. Repeated item_ids are one item id with several texts; a null item_id counts as an item
without a name (not in items_sha256).
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import saved, written

WINDOW_WORDS = 13
TERMS_BROADCAST = 200_000
#: Lower-case letters A-Z only; all other ASCII but digits and letters separates words.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text):
    """The words of a text, in order; none for null."""
    spaced = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER + _BETWEEN, _LOWER + " " * len(_BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def _small(table, rows):
    return F.broadcast(table) if rows <= TERMS_BROADCAST else table


class Index:
    """Postings (row, place, term) of the tokens of docs that are among the terms; docs' rows by
    number with doc_id and n_words."""

    def __init__(self, docs, terms):
        """docs: doc_id, text. terms: a table of distinct words, column word."""
        self.terms = saved(terms.select("word").distinct().withColumn("term", F.xxhash64("word")))
        self.n_terms = self.terms.count()
        if self.terms.select("term").distinct().count() < self.n_terms:
            raise ValueError("two terms share a hash; split the benchmark")
        split = docs.select("doc_id", words("text").alias("words"))
        # A row's number is its place in the scan; it is stored, never worked out again.
        numbered = split.select(F.monotonically_increasing_id().alias("row"), "doc_id", "words")
        tokens = numbered.select(
            "row", "doc_id", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("place", "word"))
        hits = tokens.join(_small(self.terms, self.n_terms), "word", "left")
        # Each document keeps one entry without a term, for its length.
        kept = hits.where("term IS NOT NULL OR place = 0 OR place IS NULL").select(
            "row", "doc_id", "n_words", "place", "term")
        stored = written(kept, "postings")
        self.rows = stored.where("place = 0 OR place IS NULL").select("row", "doc_id", F.col("n_words").cast("bigint").alias("n_words"))
        self.postings = stored.where("term IS NOT NULL").select("row", "place", "term")

    def frequencies(self):
        """(term, n): corpus frequency of every term, 0 included."""
        counted = self.postings.groupBy("term").agg(F.count("*").alias("n"))
        return self.terms.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def _item_terms(items, window):
    """(item, item_id, place, term, n_item): the tokens of each item; item numbers the rows."""
    split = items.select("item_id", words("text").alias("words")).where(F.size("words") > 0)
    # Equal texts under one id are one item.
    split = split.withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item"])
    tokens = split.select("item", "item_id", F.size("words").alias("n_item"), F.posexplode("words").alias("place", "word"))
    return tokens.select("item", "item_id", "n_item", F.least(F.lit(window), "n_item").alias("need"), "place", "word")


def phrase_matches(docs, items, window=WINDOW_WORDS):
    """(matches, index): matches has (row, item_id, at, end) for each maximal run of at least window
    words (or a whole shorter item) that a document row shares with an item, ends exclusive."""
    tokens = saved(_item_terms(items, window))
    index = Index(docs, tokens.select("word"))
    tokens = tokens.join(index.terms, "word").drop("word")
    n_tokens = tokens.count()

    # The rarest term of each window: the least (frequency, term, place) among its places.
    ranked = tokens.join(_small(index.frequencies(), index.n_terms), "term")
    ahead = Window.partitionBy("item").orderBy("place").rowsBetween(0, window - 1)
    rarest = ranked.select(
        "item", "place", "n_item", "need", F.min(F.struct("n", "term", F.col("place").alias("at"))).over(ahead).alias("least"))
    anchors = saved(
        rarest.where("place + need <= n_item").where("least.n > 0")
        .select("item", F.col("least.term").alias("term"), F.col("least.at").alias("item_place")).distinct())
    n_anchors = anchors.count()

    # A term that is rare in the corpus meets few postings; a frequent one only where a window has
    # nothing rarer. Postings of one row, item and shift come together as one candidate.
    candidates = (
        index.postings.join(_small(anchors, n_anchors), "term")
        .select("row", "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct())
    aligned = candidates.join(index.postings, "row").withColumn("item_place", F.col("place") - F.col("shift"))
    same = aligned.where("item_place >= 0").join(
        _small(tokens.select("item", F.col("place").alias("item_place"), "term", "item_id", "need"), n_tokens),
        ["item", "item_place", "term"])
    # Runs of neighbouring places: place less its rank is the same all along a run.
    along = Window.partitionBy("row", "item", "shift").orderBy("place")
    runs = (
        same.withColumn("run", F.col("place") - F.row_number().over(along))
        .groupBy("row", "item", "shift", "run").agg(
            F.first("item_id").alias("item_id"), F.first("need").alias("need"),
            F.min("place").alias("at"), (F.max("place") + 1).alias("end")))
    return runs.where("end - at >= need").select("row", "item_id", "at", "end"), index


def proximity_matches(index, query, within):
    """(row, at, end): the stretches of at most `within` words that start at a term of the query and
    hold all of its distinct words in any order, one for each start, as short as possible.

    query: a list of words, few by nature; index must have them among its terms.
    """
    wanted = index.terms.where(F.col("word").isin(sorted(set(query)))).select("term")
    places = index.postings.join(F.broadcast(wanted), "term")
    ahead = Window.partitionBy("row").orderBy("place").rangeBetween(0, within - 1)
    near = places.select("row", F.col("place").alias("at"), F.collect_list(F.struct("place", "term")).over(ahead).alias("near"))
    firsts = F.transform(
        F.array_distinct(F.transform("near", lambda x: x["term"])),
        lambda t: F.array_min(F.transform(F.filter("near", lambda x: x["term"] == t), lambda x: x["place"])))
    found = near.select("row", "at", firsts.alias("firsts")).where(F.size("firsts") == len(set(query)))
    return found.select("row", "at", (F.array_max("firsts") + 1).alias("end"))


def _covered(spans):
    """How many places the sorted (at, end) spans of an array cover."""
    zero = F.expr("CAST(named_struct('n', 0, 'end', 0) AS struct<n:bigint,end:int>)")
    return F.aggregate(
        spans, zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["at"], acc["end"]), F.lit(0))).cast("bigint").alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end")),
        lambda acc: acc["n"])


def contamination(docs, items, window=WINDOW_WORDS, share=20):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of docs.

    docs: doc_id, text; items: item_id, text. Contaminated: a hit, and share * n_hit >= n_words.
    """
    matches, index = phrase_matches(docs.select("doc_id", "text"), items.select("item_id", "text"), window)
    # Spans and items of one document: bounded by its length and the benchmark's size.
    by_row = matches.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("at", "end"))).alias("spans"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"))
    hits = index.rows.join(by_row, "row", "left")
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("bigint"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return hits.select("row", "doc_id", "n_words", n_hit.alias("n_hit"), names.alias("items")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean(docs, items, window=WINDOW_WORDS, share=20):
    """The rows of docs that aren't contaminated; all of a doc_id's rows go if one of them is."""
    bad = contamination(docs, items, window, share).where("contaminated AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
