"""``python tests/check_queries.py [sf_dir] [name part ...]``: compare registered queries with their SQL."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from oracle import connect, differences, spark_result  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from catalog import ORACLES, QUERIES  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(sf), []
    for name, fn in QUERIES.items():
        if wanted and not any(w == name or w == fn.__module__ or w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in ORACLES:
                problems = differences(con, ORACLES[name], df)
            else:
                problems = [] if spark_result(df)[2] else ["no rows"]
        except Exception as err:  # noqa: BLE001
            problems = [f"{type(err).__name__}: {str(err)[:700]}"]
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p[:900], flush=True)
        if problems:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
