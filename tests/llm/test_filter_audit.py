"""The audit against its SQL and against a plain count, with copies, ties, nulls and empty tables."""

import re
from itertools import permutations

import duckdb
import pytest

from motorpool.llm import filter_audit
from motorpool.llm.oracles import ORACLES
from motorpool.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["part", "filter_order", "step", *filter_audit.SUMS, "shapley"]


def fixture():
    prose = " ".join(f"word{i}" for i in range(120))
    copies = "copy " * 100
    docs = [
        (1, prose, "en"), (2, prose, "en"), (3, prose, "de"), (3, prose, "en"), (1, prose, None), (1, prose, "fr"),
        (4, copies, "en"), (5, copies, ""), (6, copies + "#", None), (7, "ABC é", "de"), (8, None, "de"),
        (9, "", "en"), (None, prose, "en"), (None, None, None), (10, prose.upper(), "en"), (11, " \t" + prose, "en"),
        (12, "x " * 50_000 + "| É", "en"), (12, "x " * 50_000 + "| É", "en"), (13, "a|b", "es"), (0, "a|b", "es"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (7, 1, None), (12, 1, 1), (None, 1, 1), (99, 1, 1)]
    return docs, labels


def counted(docs, labels):
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    bad = {i for i, _, toxic in labels if toxic == 1 and i is not None}
    told = []
    for i, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in docs)}
        told.append((lang or "", {k for k, v in failed.items() if v}, i in good, i in bad))
    out = []
    for part in {p for p, *_ in told}:
        own = [x[1:] for x in told if x[0] == part]
        rows, by_filter = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                by_filter[f] += len(here)
                rows.append((
                    part, "".join(order), step, len(left), len(here), sum(f in x[0] for x in own) - len(here),
                    sum(x[0] == {f} for x in own), sum(x[1] for x in here), sum(x[2] for x in here), f))
        out += [(*r[:-1], by_filter[r[-1]]) for r in rows]
    return sorted(out)


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = fixture()
    # Columns beside the ones in use, with names that the operator uses inside.
    given = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr(
        "*", "'p' AS part", "7 AS mask", "1 AS n", "'d' AS digest", "true AS good")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "'l' AS lone", "2 AS n")
    return given, marks


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_audit_equals_a_plain_count(tables):
    expected = counted(*fixture())
    assert len(expected) == 600 * 5
    assert rows(filter_audit.audit(*tables)) == expected


def test_audit_equals_its_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    sql = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op13_filter_audit']})").fetchall()
    assert rows(QUERIES["op13_filter_audit"](spark, SF_DIR)) == sorted(sql)


def test_the_sql_has_the_same_special_cases(tables):
    docs, labels = (t.toPandas() for t in tables)
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("labels", labels)
    sql = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op13_filter_audit']})").fetchall()
    assert sorted(sql) == counted(*fixture())


def test_empty_tables(tables):
    docs, labels = tables
    assert rows(filter_audit.audit(docs.where("1 = 0"), labels)) == []
    unlabelled = rows(filter_audit.audit(docs, labels.where("1 = 0")))
    assert unlabelled == counted(fixture()[0], [])
