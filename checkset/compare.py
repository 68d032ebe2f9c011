"""Run queries beside their SQL and report every difference.

``python -m checkset.compare [sf_dir] [name ...]``
"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

import checkset
from tidemark.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def local_session(app: str) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = configure(builder).config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
    spark = builder.config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def ordered(frame) -> tuple[list[str], list[tuple]]:
    """Column names in order, and the rows of an Arrow table sorted by their text."""
    columns = sorted(frame.column_names)
    return columns, sorted(tuple(repr(row[c]) for c in columns) for row in frame.to_pylist())


def differs(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    got = checkset.QUERIES[name](spark, sf_dir).toArrow()
    sql = checkset.ORACLES.get(name)
    if sql is None:
        return None
    want = con.sql(sql).to_arrow_table()
    got_columns, got_rows = ordered(got)
    want_columns, want_rows = ordered(want)
    if got_columns != want_columns:
        return f"columns {got_columns} instead of {want_columns}"
    types = [(c, str(got.schema.field(c).type), str(want.schema.field(c).type)) for c in got_columns]
    odd = [t for t in types if t[1].removeprefix("large_") != t[2].removeprefix("large_")]
    if odd:
        return f"types {odd}"
    if got_rows != want_rows:
        extra, missing = set(got_rows) - set(want_rows), set(want_rows) - set(got_rows)
        return f"{len(got_rows)} rows instead of {len(want_rows)}; extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    checkset.load_all()
    names = sys.argv[2:] or list(checkset.QUERIES)
    spark, con = local_session("compare"), oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differs(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
