"""Command line check: ``python tests/check_all.py [folder] [query ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                count, wrong = compare(spark, con, folder, queries[name], oracles[name])
            else:
                count, wrong = queries[name](spark, folder).count(), []
        except Exception as error:  # noqa: BLE001 - report and go on
            count, wrong = -1, [str(error)[:1500]]
        state = "ok  " if not wrong else "FAIL"
        print(f"{state} {name:28s} rows={count:<8d} {time.time() - start:6.2f}s {'' if name in oracles else '(no oracle)'}", flush=True)
        for item in wrong:
            print("     ", item, flush=True)
        if wrong:
            failed.append(name)
    print("failed:", failed)
