"""Compare every registered query with its oracle: python tests/check_all.py [folder] [name-prefix ...]."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if sys.argv[2:] and not name.startswith(tuple(sys.argv[2:])):
            continue
        t = time.time()
        try:
            df = build(spark, folder)
            note = compare(df, con, sql[name]) if name in sql else f"{df.count()} rows (no oracle)"
        except Exception as e:
            note = "ERROR " + "".join(traceback.format_exception_only(e))[:400]
        failed += note is not None and name in sql
        print(f"{name:28s} {time.time() - t:6.1f}s {note or 'ok'}", flush=True)
    print("failed:", failed)
