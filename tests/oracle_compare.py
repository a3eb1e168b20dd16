"""Compare registered queries with their SQL: `python tests/oracle_compare.py DATA_DIR [name ...]`."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402


def database(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def as_set(columns, rows):
    """Rows as sorted tuples with the columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, con, folder, name):
    """None if equal, else a short account of the difference."""
    df = spark_entry.queries()[name](spark, folder)
    ours = as_set(df.columns, df.collect())
    result = con.execute(spark_entry.oracle_sql()[name])
    theirs = as_set([column[0] for column in result.description], result.fetchall())
    if ours == theirs:
        return None
    if ours[0] != theirs[0] or len(ours[1]) != len(theirs[1]):
        return f"columns {ours[0]} / {theirs[0]}, rows {len(ours[1])} / {len(theirs[1])}"
    return [pair for pair in zip(ours[1], theirs[1]) if pair[0] != pair[1]][:3]


def main(folder, *names):
    from pyspark.sql import SparkSession

    from tallycard import session

    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    spark = session.configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    for name in names or spark_entry.queries():
        begin = time.time()
        print(f"{name}: {compare(spark, con, folder, name) or 'equal'} {time.time() - begin:.1f}s")


if __name__ == "__main__":
    main(*sys.argv[1:])
