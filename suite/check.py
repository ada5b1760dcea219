"""Compare registered queries with their SQL in DuckDB: python -m suite.check [sf_dir] [name prefix ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

import suite.catalog  # noqa: F401
from suite.registry import ORACLES, QUERIES
from suite.standins import BASE_TABLES
from zonecraft.session import build_session


def normal(value):
    if hasattr(value, "is_integer") or type(value).__name__ == "Decimal":
        value = float(value)
        if math.isnan(value):
            return None
        return int(value) if value.is_integer() else float(f"{value:.9g}")
    if isinstance(value, bool):
        return value
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return value


def kind(name: str) -> str:
    """Type family; a family that differs between the engines may be written differently although values agree."""
    name = name.lower()
    for family, members in {
        "whole": ("int", "bigint", "smallint", "tinyint", "integer"),
        "float": ("double", "float"),
        "text": ("string", "varchar"),
    }.items():
        if name in members:
            return family
    return name.split("(")[0].removesuffix("_ntz")


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(normal(row[i]) for i in order) for row in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    frame = QUERIES[name](spark, sf_dir)
    columns, got = bag(frame.columns, [tuple(r) for r in frame.collect()])
    size = sum(got.values())
    if name not in ORACLES:
        return "rows only", size
    cursor = con.execute(ORACLES[name])
    wanted_columns, wanted = bag([d[0] for d in cursor.description], cursor.fetchall())
    if columns != wanted_columns:
        return f"COLUMNS {columns} vs {wanted_columns}", size
    if got != wanted:
        return f"VALUES spark only {list((got - wanted).items())[:2]} sql only {list((wanted - got).items())[:2]}", size
    sql_types = {r[0]: kind(r[1]) for r in con.execute(f"describe {ORACLES[name]}").fetchall()}
    differing = {c: (t, sql_types[c]) for c, t in ((c, kind(t)) for c, t in frame.dtypes) if t != sql_types[c]}
    return ("ok" if not differing else f"ok, but types {differing}"), size


def main() -> int:
    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and Path(arguments[0]).is_dir() else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in QUERIES:
        if arguments and not any(name.startswith(a) or QUERIES[name].__module_of__.endswith(a) for a in arguments):
            continue
        start = time.time()
        try:
            verdict, size = compare(spark, con, name, sf_dir)
        except Exception as error:
            verdict, size = "ERROR " + str(error)[:700], -1
        fine = verdict == "rows only" or verdict.startswith("ok")
        bad += not fine
        print(f"{name:42s} {size:8d} {time.time() - start:6.1f}s {verdict}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
