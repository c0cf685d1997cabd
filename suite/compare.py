"""Run every query beside its SQL twin and report differences."""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame


def oracle_connection(folder: str):
    import duckdb

    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def difference(result: DataFrame, connection, sql: str) -> str | None:
    """What differs between a result and its SQL twin, order of rows aside."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    columns = sorted(names)

    def ordered(rows):
        return sorted(([row[i] for i in range(len(row))] for row in rows), key=repr)

    ours = ordered([[row[name] for name in columns] for row in result.collect()])
    order = [names.index(name) for name in columns]
    theirs = ordered([[row[i] for i in order] for row in expected.fetchall()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{dict(zip(columns, left))} != {dict(zip(columns, right))}"
    return None
