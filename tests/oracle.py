"""Compare registered queries with their SQL in DuckDB.  ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TESTDATA = Path("/root/testdata")


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in (TESTDATA / f"sf{sf}").glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(_cell(v) for v in row) for row in zip(*columns)), key=repr)


def schema_of(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(spark, con, name: str, sf: str) -> list[str]:
    """Empty when the query and its SQL agree in names, types and values."""
    import __spark_entry__ as entry

    spark_table = entry.queries()[name](spark, str(TESTDATA / f"sf{sf}")).toArrow()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [] if spark_table.num_rows else ["no rows"]
    duck_table = con.execute(sql).to_arrow_table()
    problems = []
    if schema_of(spark_table) != schema_of(duck_table):
        problems.append(f"schema: spark {schema_of(spark_table)} sql {schema_of(duck_table)}")
    ours, theirs = rows_of(spark_table), rows_of(duck_table)
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:3]
        only_theirs = [r for r in theirs if r not in set(ours)][:3]
        problems.append(f"rows: {len(ours)} and {len(theirs)}; only spark {only_ours}; only sql {only_theirs}")
    if not ours:
        problems.append("no rows")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].replace(".", "").isdigit() else "0.01"
    spark, con, failed = session(), connect(sf), 0
    for name in args or entry.queries():
        started = time.time()
        try:
            problems = differences(spark, con, name, sf)
        except Exception as exc:  # report every query, then go on
            problems = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s", *problems, sep="\n     ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
