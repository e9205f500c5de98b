"""Run a query on Spark and its SQL in DuckDB and say where the results differ."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None or v != v, str(v) if isinstance(v, str) else v if v == v and
                  v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def difference(df, con, sql: str) -> str | None:
    """None when names, types and values are all equal."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    theirs = list(relation.columns)
    if sorted(theirs) != names:
        return f"columns {sorted(set(names) ^ set(theirs))}"
    types = dict(zip(theirs, map(str, relation.types)))
    wrong = [(c, t, types[c]) for c, t in df.dtypes if TYPES[t] != types[c]]
    if wrong:
        return f"types {wrong}"
    place = [theirs.index(c) for c in names]
    meant = sorted((tuple(r[i] for i in place) for r in relation.fetchall()), key=_sortable)
    found = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()),
                   key=_sortable)
    if len(meant) != len(found):
        return f"{len(found)} rows instead of {len(meant)}"
    for a, b in zip(found, meant):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"found {a}, meant {b}"
    return None
