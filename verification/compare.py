"""Run a registered query in Spark and its SQL in DuckDB and compare names, types and values."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPE_NAMES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]",
}


def presented(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain types at the edge of a query: short to int, decimal and float to double rounded to ``digits``."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType)):
            column = column.cast("int")
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), digits)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def differences(df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs between a Spark result and its oracle; an empty list means equal."""
    names = sorted(df.columns)
    rows = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)
    relation = con.sql(sql)
    order = {n: i for i, n in enumerate(relation.columns)}
    if sorted(order) != names:
        return [f"columns: spark {names} oracle {sorted(order)}"]
    found = []
    for name in names:
        kind = df.schema[name].dataType.simpleString()
        theirs = str(relation.types[order[name]])
        if TYPE_NAMES.get(kind, kind) != theirs:
            found.append(f"type of {name}: spark {kind} oracle {theirs}")
    expected = sorted((tuple(_plain(r[order[n]]) for n in names) for r in relation.fetchall()), key=repr)
    if len(rows) != len(expected):
        found.append(f"rows: spark {len(rows)} oracle {len(expected)}")
    bad = [(a, b) for a, b in zip(rows, expected) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ, first: spark {dict(zip(names, bad[0][0]))} oracle {dict(zip(names, bad[0][1]))}")
    return found


def run(spark: SparkSession, folder: str, only: list[str] | None = None) -> int:
    from verification.oracles import ORACLES
    from verification.queries import QUERIES

    con = connection(folder)
    failures = 0
    for name, query in QUERIES.items():
        if only and not any(part in name for part in only):
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            if name in ORACLES:
                found = differences(df, ORACLES[name], con)
            else:
                found = [] if df.count() > 0 else ["no rows"]
        except Exception as error:  # report and go on with the other queries
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failures += bool(found)
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'FAIL' if found else 'ok  '} {time.time() - started:6.2f}s {kind:6} {name}", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    from tenura.session import local_session

    sys.exit(1 if run(local_session(), sys.argv[1], sys.argv[2:]) else 0)
