"""Run a registered query and its SQL, and compare them as unordered rows."""

import datetime
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


# Spark type -> DuckDB type of the same column.
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def compare(df, con, sql):
    """None if equal, else a short description of the first difference."""
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    want_names, want = _rows(list(kinds), result.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    types = [(n, t, kinds[n]) for n, t in df.dtypes if SAME_TYPE[t] != kinds[n]]
    if types:
        return f"types {types}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            different = [(n, a, b) for n, a, b in zip(got_names, g, w) if a != b]
            return f"first difference {different[:4]} in row {g[:6]}"
    return None
