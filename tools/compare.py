"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

usage: python tools/compare.py [sf] [name-prefix ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from starfold.checks import load_all  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = sys.argv[2:]
    data = f"/root/testdata/sf{sf}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.log.level", "ERROR").getOrCreate())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    queries, oracles = load_all()
    bad = []
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            t = time.time()
            df = fn(spark, data)
            rows = df.collect()
            dt = time.time() - t
            cols = sorted(df.columns)
            mine = sorted((tuple(norm(row[c]) for c in cols) for row in rows), key=repr)
            if name not in oracles:
                print(f"rows  {name:40s} {len(mine):8d} {dt:6.2f}s", flush=True)
                continue
            t = time.time()
            rel = con.execute(oracles[name])
            names = [d[0] for d in rel.description]
            theirs_rows = rel.fetchall()
            do = time.time() - t
            if sorted(names) != cols:
                raise AssertionError(f"columns {cols} vs {sorted(names)}")
            order = [names.index(c) for c in cols]
            theirs = sorted((tuple(norm(row[i]) for i in order) for row in theirs_rows), key=repr)
            ok = mine == theirs
            print(f"{'ok   ' if ok else 'DIFF '} {name:40s} {len(mine):8d} {dt:6.2f}s duck {do:.2f}s", flush=True)
            if not ok:
                bad.append(name)
                a, b = set(mine), set(theirs)
                print("   ", cols, len(mine), len(theirs), "spark only", len(a - b), "duck only", len(b - a))
                print("    spark", sorted(a - b, key=repr)[:3])
                print("    duck ", sorted(b - a, key=repr)[:3])
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:700]}", flush=True)
    print("bad:", bad)


main()
