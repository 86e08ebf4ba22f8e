"""Secrets in texts: fixed patterns, and tokens that a battery of tests can't tell from random.

Only DataFrame functions: patterns run in the JVM, and the position of each match follows from the
lengths of what lies between matches.

Tokens are runs of TOKEN_LEAST or more of [A-Za-z0-9+/_-]. The encoding is inferred from the letters
in use (see ENCODINGS). Four tests of the hypothesis that each letter was drawn alike and
independently: chi-squared of the letter counts and of the counts of capitals, small letters and the
rest, runs above and below the middle of the alphabet, and serial correlation of neighbours; their
least p-value times four is the token's p. Random tokens have p spread over 0..1, text piles up near 0.

Short text passes such tests now and then, so a class of tokens (encoding and length) has to show
that what it accepts is random: the letters of its accepted tokens, taken together, must be as even
as drawn ones. That is no part of a token's p, and text of the same length cannot meet it, since its
frequent letters are the same from token to token. The first PREFIX letters are left out (kinds of
keys share them), and a token counts once however often it is repeated. The chi-squared distance of
the letter shares from even ones, at its upper 95% confidence bound, over the distance of text
(TEXT_DISTANCE) bounds the squared share of text; the least p accepted is the first of a fixed grid
at which that share is at most FALSE_SHARE. Few tokens have a wide bound: their class, as one of text
only, gets no limit, and none of its tokens is listed.

Results in special cases: a null or empty text has no spans. Repeated rows are scanned one by one,
a null doc_id stays null. Columns of the input other than doc_id and text don't matter.
"""

import math

from pyspark.sql import functions as F

TOKEN_LEAST = 20
FALSE_SHARE = 0.05
GRID = (0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5)
PREFIX = 8

#: Fixed patterns: kind, pattern, the group whose length counts, its least length. Looking ahead for
#: a first letter only makes the first one faster.
KINDS = (
    ("assign", r"""(?=[pPsStTaA])((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # A match is a whole run, so a least length in the pattern drops the same ones.
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
TOKENS = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % TOKEN_LEAST
_SPAN = "struct<at:int,kind_order:int,end:int,kind:string>"


def _bound(value, use):
    """use(value) with value worked out, and written into the plan, once however often use() names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _located(text, pattern):
    """The matches of pattern in a text as structs (at, end, found); empty where there is none.

    split() and regexp_extract_all() find the same leftmost matches, so pieces and matches alternate.
    """
    state = "struct<at:int,out:array<struct<at:int,end:int,hit:string>>>"

    def step(acc, pair):
        start = acc["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        one = F.struct(start.alias("at"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

    empty = F.expr(f"CAST(named_struct('at', 0, 'out', array()) AS {state})")
    none = F.expr("CAST(array() AS array<struct<at:int,end:int,hit:string>>)")

    def located(found):
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        pairs = F.zip_with(gaps, found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
        return F.when(F.size(found) > 0, F.aggregate(pairs, empty, step, lambda acc: acc["out"])).otherwise(none)

    return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def base_spans(text):
    """Spans of all fixed patterns, by start and then in the order of KINDS."""
    def of(order, kind, pattern, group, least):
        long = F.filter(
            _located(text, pattern), lambda s: F.char_length(F.regexp_extract(s["hit"], pattern, group)) >= least)
        return F.transform(long, lambda s: F.struct(
            s["at"].alias("at"), F.lit(order).alias("kind_order"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.sort_array(F.concat(*[of(order, *kind) for order, kind in enumerate(KINDS)]))


def _upper_tail(z):
    """P(Z > z) of the standard normal for z >= 0 (error below 1e-7)."""
    def tail(z, t):
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-z * z / 2) / F.sqrt(F.lit(6.283185307179586)) * poly

    return _bound(z, lambda z: _bound(1 / (1 + 0.2316419 * z), lambda t: tail(z, t)))


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding: the letters in order. The first whose letters hold a whole token is inferred.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("base32", _UPPER + "234567"),
    ("lower", _LOWER + _DIGITS),
    ("upper", _UPPER + _DIGITS),
    ("alnum", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
)
#: For each encoding, a low value of the sum of (share - even share)^2 / even share over the letters
#: of text in it: numbers for hex, capitals or small letters alone; CamelCase words that pass the tests have 1.5.
TEXT_DISTANCE = (0.6, 1.0, 1.0, 1.0, 1.0, 1.0)


def _encoding(token):
    out = F.when(token.rlike("^[0-9a-f]+$"), 0).when(token.rlike("^[A-Z2-7]+$"), 1)
    out = out.when(token.rlike("^[a-z0-9]+$"), 2).when(token.rlike("^[A-Z0-9]+$"), 3)
    return out.when(token.rlike("^[A-Za-z0-9]+$"), 4).otherwise(5)


def _even_letters(encoding):
    """How many letters of an encoding count for evenness: + and / don't, as a token without them is
    taken for another encoding."""
    return min(62, len(ENCODINGS[encoding][1]))


def _codes(token):
    """Places of a token's letters in its alphabet; the URL forms - and _ count as + and /."""
    encoding = _encoding(token)
    alphabet = F.element_at(F.array(*[F.lit(a) for _, a in ENCODINGS]), encoding + 1)
    letters = F.split(F.translate(token, "-_", "+/"), "")
    return F.transform(letters, lambda c: F.instr(alphabet, c) - 1)


def _chi_tail(chi, freedom):
    """P(X > chi) of chi-squared, by Wilson and Hilferty's normal."""
    z = (F.pow(F.greatest(chi, F.lit(0.0)) / freedom, F.lit(1 / 3)) - (1 - 2 / (9 * freedom))) / F.sqrt(2 / (9 * freedom))
    return _bound(z, lambda z: _bound(_upper_tail(F.abs(z)), lambda tail: F.when(z > 0, tail).otherwise(1 - tail)))


def _kinds_tested(hit, encoding):
    """p-value of how many capitals, small letters and others a token has."""
    def tested(counts):
        n, upper, lower, other = (counts[c] for c in ("n", "upper", "lower", "other"))
        out = F.lit(1.0)
        for i, (_, alphabet) in enumerate(ENCODINGS):
            k, up, low = len(alphabet), sum(c in _UPPER for c in alphabet), sum(c in _LOWER for c in alphabet)
            kinds = [(c, size) for c, size in ((upper, up), (lower, low), (other, k - up - low)) if size]
            chi = sum((c - n * (size / k)) * (c - n * (size / k)) / (n * (size / k)) for c, size in kinds)
            out = F.when(encoding == i, _chi_tail(chi, F.lit(float(len(kinds) - 1)))).otherwise(out)
        return out

    n = F.char_length(hit).cast("double")
    upper = n - F.char_length(F.regexp_replace(hit, "[A-Z]", ""))
    lower = n - F.char_length(F.regexp_replace(hit, "[a-z]", ""))
    first = F.struct(n.alias("n"), upper.alias("upper"), lower.alias("lower"))
    return _bound(first, lambda c: _bound(
        F.struct(c["n"].alias("n"), c["upper"].alias("upper"), c["lower"].alias("lower"),
                 (c["n"] - c["upper"] - c["lower"]).alias("other")), tested))


def _tested(codes, letters, p_kinds):
    """p-value of the battery for a list of places in an alphabet of so many letters."""
    def tested(v):
        n, k, high, above = (v[c] for c in ("n", "k", "high", "above"))
        squares = F.aggregate(
            F.array_distinct(codes), F.lit(0.0),
            lambda acc, c: acc + F.pow(F.size(F.filter(codes, lambda x: x == c)).cast("double"), F.lit(2.0)))
        p_chi = _chi_tail(k / n * squares - n, k - 1)
        below = n - above
        steps = F.slice(codes, 2, F.size(codes) - 1)
        changes = F.aggregate(
            F.zip_with(F.slice(high, 1, F.size(codes) - 1), F.slice(high, 2, F.size(codes) - 1), lambda a, b: (a != b).cast("int")),
            F.lit(0), lambda a, x: a + x)

        def runs(mean):
            spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
            # One side empty: as unlikely as n equal throws.
            return F.when((above == 0) | (below == 0), F.pow(F.lit(2.0), 1 - n)).otherwise(
                2 * _upper_tail(F.abs(changes + 1 - mean) / spread))

        p_runs = _bound(2 * above * below / n + 1, runs)
        centre = (k - 1) / 2
        products = F.aggregate(
            F.zip_with(F.slice(codes, 1, F.size(codes) - 1), steps, lambda a, b: (a - centre) * (b - centre)),
            F.lit(0.0), lambda acc, x: acc + x)
        # Variance of a product of two places drawn alike: that of one place, squared.
        p_serial = 2 * _upper_tail(F.abs(products) / (((k * k - 1) / 12) * F.sqrt(n - 1)))
        return F.least(F.lit(1.0), 4 * F.least(p_chi, p_kinds, p_runs, p_serial))

    def counted(high):
        above = F.aggregate(high, F.lit(0), lambda a, x: a + x).cast("double")
        return _bound(F.struct(
            F.size(codes).cast("double").alias("n"), letters.cast("double").alias("k"),
            high.alias("high"), above.alias("above")), tested)

    return _bound(F.transform(codes, lambda c: (c >= letters / 2).cast("int")), counted)


def _tokens(text):
    """The candidate tokens of a text: (at, end, hit, enc, size class)."""
    def classed(s):
        size = F.floor(2 * F.log2((s["end"] - s["at"]).cast("double"))).cast("int")
        return F.struct(s["at"].alias("at"), s["end"].alias("end"), s["hit"].alias("hit"),
                        _encoding(s["hit"]).alias("enc"), size.alias("len"))

    return F.transform(_located(text, TOKENS), classed)


def _p(hit, encoding):
    letters = F.element_at(F.array(*[F.lit(len(a)) for _, a in ENCODINGS]), encoding + 1)
    return _bound(_codes(hit), lambda codes: _tested(codes, letters, _kinds_tested(hit, encoding)))


def text_share(counts, encoding):
    """Upper 95% bound of the share of text among tokens, from the counts of their letters."""
    n, k = sum(counts), _even_letters(encoding)
    if not n:
        return 1.0
    distance = k * sum((c / n) ** 2 for c in counts) - 1 - (k - 1) / n
    return min(1.0, math.sqrt(max(0.0, distance + 1.645 * math.sqrt(2 * (k - 1)) / n) / TEXT_DISTANCE[encoding]))


def accepted(docs, false_share=FALSE_SHARE):
    """{(encoding, length class): least p of a token taken for random}, from the whole corpus."""
    tokens = docs.select(F.explode(_tokens(F.coalesce("text", F.lit("")))).alias("t")).select("t.enc", "t.len", "t.hit").distinct()
    passed = tokens.withColumn("p", _p(F.col("hit"), F.col("enc"))).where(F.col("p") >= GRID[0])
    letters = passed.select("enc", "len", "p", F.explode(F.slice(_codes(F.col("hit")), PREFIX + 1, F.length("hit"))).alias("code"))
    above = [F.count_if(F.col("p") >= g).alias(f"g{i}") for i, g in enumerate(GRID)]
    # A row for each letter of an encoding and power of the root of two: a few thousand at most.
    classes = {}
    for row in letters.where("code < 62").groupBy("enc", "len", "code").agg(*above).collect():
        classes.setdefault((row["enc"], row["len"]), []).append(row)
    out = {}
    for (enc, size), rows in classes.items():
        for i, limit in enumerate(GRID):
            if text_share([row[f"g{i}"] for row in rows], enc) <= false_share:
                out[enc, size] = limit
                break
    return out


def random_spans(text, limits):
    """Spans of the tokens that pass for random under limits."""
    if not limits:
        return F.expr(f"CAST(array() AS array<{_SPAN}>)")
    known = F.create_map(*[F.lit(x) for (enc, size), p in sorted(limits.items()) for x in (enc * 1000 + size, p)])

    def random(t):
        found = F.element_at(known, t["enc"] * 1000 + t["len"])
        return F.when(found.isNotNull(), _p(t["hit"], t["enc"]) >= found).otherwise(F.lit(False))

    return F.transform(F.filter(_tokens(text), random), lambda t: F.struct(
        t["at"].alias("at"), F.lit(len(KINDS)).alias("kind_order"), t["end"].alias("end"), F.lit("random").alias("kind")))


def _written(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"].cast("string"), s["end"].cast("string"))))


def scanned(docs, limits=None):
    """docs with a column spans: array of (at, kind_order, end, kind), by start, ends exclusive.

    Random tokens inside a span of a fixed pattern aren't listed again.
    """
    limits = accepted(docs) if limits is None else limits
    text = F.coalesce("text", F.lit(""))
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    based = docs.select(*kept, base_spans(text).alias("base"), random_spans(text, limits).alias("\0random"))
    new = F.filter("\0random", lambda r: ~F.exists("base", lambda b: (b["at"] <= r["at"]) & (r["end"] <= b["end"])))
    return based.select(*kept, "base", F.sort_array(F.concat("base", new)).alias("spans"))


def secrets(docs):
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row of docs (doc_id, text)."""
    found = scanned(docs.select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind, *_ in KINDS], F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redacted(docs, mark="[secret]"):
    """docs with every span of text replaced by mark; overlapping spans make one. A text without
    spans stays as it is, null included."""
    found = scanned(docs)
    state = "struct<at:int,out:string>"
    text = F.col("text")

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["at"] - acc["at"], F.lit(0)))
        begun = s["at"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(begun, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    empty = F.expr(f"CAST(named_struct('at', 0, 'out', '') AS {state})")
    clean = F.aggregate("spans", empty, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))))
    kept = [F.when(F.size("spans") > 0, clean).otherwise(text).alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in ("base", "spans")]
    return found.select(*kept)
