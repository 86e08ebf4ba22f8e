"""Run queries beside their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

import datetime as dt
import sys
import time

import duckdb

from motorpool.session import build_session

from .oracle import ORACLES
from .queries import QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return [_plain(v) for v in value.values()]
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def differences(spark, con, name, sf_dir):
    """Empty when both sides agree; exact, floating-point values included."""
    result = QUERIES[name](spark, sf_dir)
    ours = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    relation = con.sql(ORACLES[name])
    theirs = _sorted_rows(relation.columns, relation.fetchall())
    if sorted(result.columns) != sorted(relation.columns):
        return [f"columns {sorted(set(result.columns) ^ set(relation.columns))}"]
    types = dict(zip(relation.columns, map(str, relation.types)))
    notes = []
    for field in result.schema:
        names = {
            "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
        }
        kind = field.dataType.simpleString()
        if kind in names and types[field.name] != names[kind]:
            notes.append(f"type of {field.name}: {kind} / {types[field.name]}")
    if ours != theirs:
        only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
        notes.append(f"rows {len(ours)} / {len(theirs)}, differing {len(only_ours)} / {len(only_theirs)}")
        notes += sorted(only_ours)[:2] + sorted(only_theirs)[:2]
    elif not ours:
        notes.append("no rows")
    return notes


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    session = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    failed = 0
    for query_name in chosen:
        began = time.time()
        try:
            found = differences(session, database, query_name, folder)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {query_name} {time.time() - began:.1f}s", *found, sep="\n     ", flush=True)
    print("failed:", failed, "of", len(chosen))
