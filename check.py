"""Compare registered queries with their SQL: ``check.py SF_DIR [name ...]``."""

import sys
import time

from pyspark.sql import SparkSession

from dunlin.plans import QUERIES, SQL
from tests.oracle import compare, connect


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = []
    for name in names or list(QUERIES):
        began, sql_time = time.time(), 0.0
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in SQL:
                note, sql_time = compare(con, df, SQL[name])
            else:
                note = "" if df.count() else "no rows"
        except Exception as e:  # keep going, report at the end
            note = f"{type(e).__name__}: {str(e)[:500]}"
        if note:
            failed.append(name)
        kind = "sql" if name in SQL else "rows"
        print(f"{time.time() - began - sql_time:6.2f}s {sql_time:5.1f} {kind:4s} {name:24s} {note or 'ok'}", flush=True)
    print("failed:", failed)


main()
