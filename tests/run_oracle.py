"""``python tests/run_oracle.py [name-part ...]``: compare queries with their SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed, seconds = connect(sf), [], {}
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if sys.argv[1:] and not any(a in name for a in sys.argv[1:]):
            continue
        began = time.time()
        try:
            df = run(spark, sf)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() > 0 else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:900]}"]
        seconds[name] = time.time() - began
        print(f"{'ok ' if not problems else 'BAD'} {seconds[name]:6.1f}s {name} {'' if name in oracles else '(rows only)'}", flush=True)
        for p in problems:
            print("     ", p)
        if problems:
            failed.append(name)
    print(f"{len(seconds)} queries, {len(failed)} failed: {failed}; {sum(seconds.values()):.0f}s")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
