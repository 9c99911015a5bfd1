"""Times the headline queries: warm session, median of three, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("as_of_join_exposure", "scd2_user_events", "exposure_change_daily", "recon_row_hash", "dedupe_latest_orders", "exposure_by_nation", "scd2_customer_priority", "dq_checks", "scd2_replayed")


def main() -> None:
    from ledgerline.plans.queries import QUERIES
    from ledgerline.session import session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):  # the first warms up
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(runs[1:]), 4)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
