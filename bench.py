"""Seconds per checked query over the tables in $BENCH_SF_DIR; prints one JSON line.

Every query is run in full into a sink that discards rows. ``run_batch`` is the
whole build with all tables written. ``landing`` turns the tables into a CSV
feed and ``star_schema`` writes what the queries then read. Names as arguments
limit the run to them. One query over the smallest tables, not timed, starts the JVM up.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillmart.plans.batch import run_batch  # noqa: E402
from tillmart.plans.registry import queries, star_of  # noqa: E402
from tillmart.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def whole_build(spark, sf_dir: str) -> None:
    star = star_of(spark, sf_dir)
    run_batch(spark, star.raw, star.raw_families, star.path("bench"))


def star_schema(spark, sf_dir: str) -> None:
    for name in ("dim_customers", "int_transactions"):
        star_of(spark, sf_dir).lake.table(name)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.sql.files.openCostInBytes": "1m",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {
        "landing": lambda: star_of(spark, SF_DIR).landing,
        "star_schema": lambda: star_schema(spark, SF_DIR),
    }
    for name, build in queries().items():
        if name == "full_build":  # that is run_batch
            continue
        runs[name] = lambda build=build: discard(build(spark, SF_DIR))
    runs["run_batch"] = lambda: whole_build(spark, SF_DIR)
    wanted = sys.argv[1:] or list(runs)

    if os.path.isdir(WARM_UP_DIR):
        discard(queries()["int_customers"](spark, WARM_UP_DIR))
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        runs[name]()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
