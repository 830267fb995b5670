"""Run registered queries against DuckDB and report differences.

python -m checks.compare [sf dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import all_queries
from postlake.session import local_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _rows(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """What differs between the Spark result and the expected one, or None."""
    df = all_queries()[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    wanted = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    if got == wanted:
        return None
    extra, missing = got - wanted, wanted - got
    return (
        f"{got.total()} rows instead of {wanted.total()}; {extra.total()} differ\n"
        f"  got    {next(iter(extra), None)}\n  wanted {next(iter(missing), None)}"
    )


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    spark, con, failed = local_session(), duck(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        start = time.time()
        problem = difference(spark, con, sf_dir, name) if name in ORACLE else "no SQL"
        failed += problem not in (None, "no SQL")
        print(f"{name:24} {time.time() - start:6.2f}s  {(problem or 'equal')[:1500]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
