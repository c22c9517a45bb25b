"""Times the reports at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

``queries`` holds the median seconds of three runs after two warm-up runs; ``naive`` the same
for the plain forms of ``benchmarks/naive_forms.py``, which are not part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from benchmarks import naive_forms  # noqa: E402
from tarmac import catalog  # noqa: E402
from tarmac.sources import read_star  # noqa: E402

WARM_UPS = 2
RUNS = 3
HEADLINE = [
    "top_models",
    "departure_delay",
    "departure_delay_total_minutes",
    "popular_types_all",
    "popular_types_country",
    "popular_types_distinct_tails",
    "type_counts",
    "approx_top_types",
]


def seconds(build) -> float:
    times = []
    for _ in range(WARM_UPS + RUNS):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[WARM_UPS:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarmac-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    registered = catalog.queries()
    timed = {name: seconds(lambda: registered[name](spark, folder)) for name in HEADLINE}

    def dims() -> tuple[DataFrame, DataFrame, DataFrame]:
        star = read_star(spark, folder)  # each run opens the tables, as the queries do
        return star.flights, star.aircrafts, star.airlines

    plain = {
        "top_models": lambda: naive_forms.top_models(*dims()[:2], catalog.MANUFACTURER),
        "departure_delay": lambda: naive_forms.departure_delay(*dims(), catalog.YEAR, catalog.COUNTRY),
        "popular_types_all": lambda: naive_forms.popular_types(*dims()),
        "popular_types_country": lambda: naive_forms.popular_types(*dims(), catalog.COUNTRY),
    }
    naive = {name: seconds(build) for name, build in plain.items()}
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "report_seconds_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "naive": naive,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
