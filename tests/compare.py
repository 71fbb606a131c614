"""Spark rows against SQL rows, column by column, regardless of order."""

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def database(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return None if value is None else str(value)


def bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def assert_same(frame, connection, sql):
    # The tests' driver holds both results; the library never does.
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    expected = bag(names, result.fetchall())
    actual = bag(frame.columns, frame.collect())
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"missing {sum(missing.values())}, e.g. {list(missing)[:2]}; "
        f"extra {sum(extra.values())}, e.g. {list(extra)[:2]}"
    )
    return sum(actual.values())
