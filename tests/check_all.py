"""Run every registered query against its SQL and print one line for each: python tests/check_all.py [sf_dir] [name...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from checks import ORACLES, QUERIES
from tests.oracle import connect, difference


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.monotonic()
        try:
            frame = QUERIES[name](spark, sf_dir)
            found = difference(frame, con, ORACLES[name]) if name in ORACLES else f"no SQL; {frame.count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{name:32} {time.monotonic() - start:6.2f} s  {(found or 'equal')[:900]}", flush=True)
    print(f"{len(names)} queries, {bad} not equal")


if __name__ == "__main__":
    main()
