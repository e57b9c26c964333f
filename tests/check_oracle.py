"""Compare registered queries with their oracle SQL: `python tests/check_oracle.py DIR [names]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(directory: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, directory: str) -> tuple[bool, str]:
    """True when columns and every value are equal, else the first difference."""
    df = entry_module.queries()[name](spark, directory)
    got = _rows(df.columns, df.collect())
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got)} rows, no oracle"
    rel = con.sql(sql)
    want = _rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if len(got) != len(want):
        return False, f"{len(got)} rows != {len(want)}: {set(got) ^ set(want) and list(set(got) ^ set(want))[:2]}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return False, f"{sorted(df.columns)}\n   got  {g}\n   want {w}"
    return True, f"{len(got)} rows"


def main() -> int:
    directory, names = sys.argv[1], sys.argv[2:] or list(entry_module.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(directory), 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, directory)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
