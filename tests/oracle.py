"""Run registered queries against DuckDB on the same tables.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, (bool, type(None), str)):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else number
    return str(value)


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows),
                  key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(df, con, sql: str) -> str | None:
    """A description of the first difference, or None."""
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    duck_rows = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows against {len(duck_rows)}"
    for a, b in zip(ordered(spark_rows, df.columns), ordered(duck_rows, names)):
        if a != b:
            return f"{a} against {b} ({sorted(names)})"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as contract
    from turnout.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    sql, failed = contract.oracle_sql(), []
    for name, run in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {time.time() - start:6.2f}s {name}"
              + (f": {problem}" if problem else ""), flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
