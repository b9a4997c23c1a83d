"""Compare registered queries with their SQL in DuckDB. Usage: oracle_check.py SF_DIR [name ...]"""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql):
    """None if equal, else a short description."""
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    a, b = rows_of(got_names, got), rows_of(want_names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference {x} != {y}"
    types = [type(v) for v in a[0]] if a else []
    return None if not a or types else "no types"


if __name__ == "__main__":
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
        "spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        t = time.time()
        try:
            if name in oracles:
                problem = compare(queries[name](spark, sf), con, oracles[name])
            else:
                problem = f"(no oracle) {queries[name](spark, sf).count()} rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem and not problem.startswith("(no"))
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
