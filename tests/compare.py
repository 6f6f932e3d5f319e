"""Compare a Spark result with DuckDB's, column by column and row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_KINDS = {
    "bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "double", "float": "float",
    "string": "string", "boolean": "bool", "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp_tz",
}
_DUCK_KINDS = {
    "BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
    "TIMESTAMP WITH TIME ZONE": "timestamp_tz", "HUGEINT": "hugeint",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value.normalize()))
    if isinstance(value, dt.datetime):
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None).isoformat() if value.tzinfo else value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types, row count and values agree."""
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    duck_types = {d[0]: _DUCK_KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    want = _rows(duck_names, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(duck_names):
        return [f"columns {sorted(df.columns)} != {sorted(duck_names)}"]
    for name, kind in df.dtypes:
        mine = _KINDS.get(kind, kind.upper().replace("DECIMAL", "DECIMAL"))
        if mine != duck_types[name]:
            problems.append(f"type of {name}: {kind} != {duck_types[name]}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    elif got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        problems.append(f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}")
    if not want:
        problems.append("EMPTY")
    return problems
