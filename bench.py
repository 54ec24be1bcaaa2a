"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and print one JSON line.

build_star_schema and build_raw_etl time the runs that write the stage tables; the other entries
read them, as a user asking many questions of one model does. The messy extracts that the ETL reads are a
fixture; writing them is not timed. Every result is written to the
no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import platform
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from attain import catalog  # noqa: E402
from attain.plans import commission, kpi  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("attain-bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, work):
        started = time.time()
        work()
        times[name] = round(time.time() - started, 3)

    def build_star_schema():
        m = catalog.model(spark, folder)
        commission.kpi_rep_month(m)
        kpi.team_month(m)

    def build_raw_etl():
        catalog.run(spark, folder).routed.count()

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    timed("build_star_schema", build_star_schema)
    catalog.run(spark, folder)
    timed("build_raw_etl", build_raw_etl)
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    for name, query in catalog.queries().items():
        if not only or name in only:
            timed(name, lambda: query(spark, folder).write.format("noop").mode("overwrite").save())
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "attain_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus),
                      "spark": spark.version, "python": platform.python_version()}))
    spark.stop()


if __name__ == "__main__":
    main()
