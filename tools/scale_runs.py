"""Times of median, quantiles and dense ids on the register repeated 1, 10 and 100 times.

usage: python tools/scale_runs.py [sf_dir] [factor ...]; prints one JSON line for each run, with
the longest task of all its stages from Spark's event log.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from catalogue import bindings as b  # noqa: E402
from landledger.operators.row_ids import dense_row_id  # noqa: E402
from landledger.plans import exploration, marts  # noqa: E402
from landledger.session import build_session  # noqa: E402
from landledger.storage import materialise, release  # noqa: E402

FACTORS = (1, 10, 100)


def longest_tasks(events: Path) -> dict[str, float]:
    """Longest task in seconds by job description."""
    name_of, longest = {}, {}
    for file in events.rglob("*"):
        for line in file.open() if file.is_file() else ():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = event.get("Properties", {}).get("spark.job.description")
                name_of.update({stage: name for stage in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and (name := name_of.get(event["Stage ID"])):
                seconds = event.get("Task Metrics", {}).get("Executor Run Time", 0) / 1000
                longest[name] = max(longest.get(name, 0.0), seconds)
    return longest


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    factors = [int(f) for f in sys.argv[2:]] or FACTORS
    events = Path(tempfile.mkdtemp(prefix="events-"))
    spark = build_session(
        "scale", "local[8]",
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "32",
         "spark.driver.memory": "16g", "spark.eventLog.enabled": "true", "spark.eventLog.dir": events.as_uri(),
         "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = []
    for factor in factors:
        spark.sparkContext.setJobDescription("input")
        one = b.tx(spark, sf_dir, "sale_date", "sale_year", "county", "price_eur", "address", "is_new_property", "is_second_hand_property")
        # each copy has prices and addresses of its own
        copy = (F.col("id") % 9973 / 100).cast("decimal(14,2)")
        tx = one.crossJoin(spark.range(factor)).withColumns(
            {"price_eur": (F.col("price_eur") + copy).cast("decimal(14,2)"), "address": F.concat("address", F.lit("/"), "id")}
        ).drop("id")
        tx = materialise(tx, "scale-input")
        rows = tx.count()
        for name, build in {
            "median by county and year": lambda tx=tx: marts.county_market(tx),
            "eleven quantiles": lambda tx=tx: exploration.price_percentiles(tx),
            "dense ids": lambda tx=tx: dense_row_id(tx.select("sale_date", "address", "county", "price_eur"), ["sale_date", "address"], "id"),
        }.items():
            label = f"{name} x{factor}"
            spark.sparkContext.setJobDescription(label)
            started = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append((label, name, factor, rows, round(time.perf_counter() - started, 2)))
        release(spark)
    spark.stop()
    longest = longest_tasks(events)
    for label, name, factor, rows, seconds in runs:
        print(json.dumps({"job": name, "factor": factor, "rows": rows, "seconds": seconds, "longest_task_s": round(longest.get(label, 0), 2)}))


if __name__ == "__main__":
    main()
