"""Run registered queries in Spark and their SQL in DuckDB, and compare all rows.

``python tests/oracle_check.py [sf] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def difference(spark, con, sf_dir, run, sql):
    """None when both engines give the same columns and rows, else a short text."""
    frame = run(spark, sf_dir)
    found = frame.collect()
    answer = con.execute(sql)
    names = [column[0] for column in answer.description]
    wanted = answer.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(set(frame.columns) ^ set(names))}"
    if len(found) != len(wanted):
        return f"rows {len(found)} != {len(wanted)}"
    left, right = sorted_rows(found, frame.columns), sorted_rows(wanted, names)
    for a, b in zip(left, right):
        if a != b:
            cols = sorted(names)
            off = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
            return f"first difference {off} in {a}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in oracles:
                result = difference(spark, con, sf_dir, run, oracles[name])
            else:
                result = f"(no SQL) rows={run(spark, sf_dir).count()}"
        except Exception as error:  # report and go on to the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(result) and not result.startswith("(no SQL)")
        print(f"{'ok  ' if not result else 'DIFF'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    missing = set(oracles) - set(entry.queries())
    print("bad:", bad, "SQL without query:", missing)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
