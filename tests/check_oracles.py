"""Run queries beside their SQL oracles: python tests/check_oracles.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def database(sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _plain(value):
    if value is None:
        return "\0NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, db, sql):
    """None when equal, else what differs."""
    got = df.collect()
    relation = db.sql(sql)
    wanted = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for field in df.schema.fields:
        kind = KINDS.get(field.dataType.typeName(), field.dataType.typeName())
        if kind != theirs[field.name]:
            return f"type of {field.name}: {kind} != {theirs[field.name]}"
    a, b = _rows(df.columns, got), _rows(list(relation.columns), wanted)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
        return f"{len(bad)} rows differ, first: {bad[0][0]} != {bad[0][1]} {sorted(df.columns)}"
    return None


def main():
    from conftest import make_session

    from faultline import catalog

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = make_session()
    db = database(sf_dir)
    oracles = catalog.oracle_sql()
    failed = []
    for name, run in catalog.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(run(spark, sf_dir), db, oracles[name])
            else:
                rows = run(spark, sf_dir).count()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
