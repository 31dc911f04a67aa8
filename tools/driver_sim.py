"""Imitate the driver: load __spark_entry__.py by path from another working
directory, use a plain default SparkSession (none of this package's
settings), run entry() and every query against its DuckDB oracle on sf0.01.

    python tools/driver_sim.py            # run from any directory; try TZ=Asia/Tokyo too
    DRIVER_SIM_CONF=spark.sql.ansi.enabled=false python tools/driver_sim.py
"""

import importlib.util
import os
import sys
import time

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(REPO, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.master("local[8]")
    for pair in filter(None, os.environ.get("DRIVER_SIM_CONF", "").split(",")):
        key, value = pair.split("=", 1)
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    t0 = time.time()
    df = entry.entry(spark)
    print("entry", len(df.collect()), "rows", round(time.time() - t0, 1), "s", df.schema.simpleString()[:120])
    sys.path.insert(0, os.path.join(REPO, "tools"))
    from oracle_check import check, duck

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    con = duck(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name, build in qs.items():
        res = check(spark, name, build, oracles.get(name), sf_dir, con)
        if res["status"] not in ("ok", "rows-only"):
            bad.append(res)
    print("queries", len(qs), "oracles", len(oracles), "bad", bad)


if __name__ == "__main__":
    os.chdir("/tmp")
    main()
