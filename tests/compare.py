"""Run check queries and their SQL side by side: python tests/compare.py [sf_dir] [name ...]"""

import math
import os
import sys
import tempfile
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    db = duckdb.connect()
    for file in os.listdir(sf_dir):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, db, sql):
    """Number of rows of either side the other lacks, with a few examples."""
    mine = _bag(df.columns, df.collect())
    result = db.execute(sql)
    theirs = _bag([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return -1, [mine[0], theirs[0]]
    left, right = mine[1] - theirs[1], theirs[1] - mine[1]
    return sum(left.values()) + sum(right.values()), list(left)[:2] + list(right)[:2]


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = [a for a in args if "/" not in a]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="opinara-"))
             .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name not in sql:
                print(f"{name:30} rows {query(spark, sf_dir).count()}", flush=True)
                continue
            n, sample = differences(query(spark, sf_dir), db, sql[name])
        except Exception as error:
            n, sample = "error", [str(error)[:1500]]
        bad += n != 0
        print(f"{name:30} {'ok' if n == 0 else n} {time.time() - start:.1f}s", flush=True)
        for row in sample if n else []:
            print("    ", str(row)[:1500], flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
