"""Time the layers at the volume of three real months: about 9.7 million raw rows.

The rows are the test table's events, each repeated with shifted times and ids, so they are distinct trips.
Usage: ``python bench_layers.py FRESH_DIR [repeats]``; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime, timezone

from layerwright.config import IngestSpec
from layerwright.plans import landing, medallion
from layerwright.session import local_session
from layerwright.sources import tables
from layerwright.workloads.trips import raw_trips


def deliver(spark, sf_dir: str, root: str, repeats: int) -> None:
    """Monthly files of raw trips below ``root``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(16)
    copies = events.selectExpr("*", f"explode(sequence(0, {repeats - 1})) AS k")
    spread = copies.selectExpr(
        "event_id + k * 1000000L AS event_id",
        "ts + make_dt_interval(0, 0, 0, k) AS ts",
        "user_id",
        "event_type",
        "value",
        "props",
    )
    spread.write.parquet(f"{root}/events.parquet")
    trips = raw_trips(spark, root).drop("event_id", "copy_no").withColumnRenamed("file_month", "month")
    trips.selectExpr("*", "2024 AS year").write.partitionBy("year", "month").parquet(f"{root}/deliveries")


def main() -> None:
    root, repeats = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 95
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="layerwright-layers")
    deliver(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), root, repeats)
    layout = landing.Layout(f"{root}/lake")
    seconds = {}

    def timed(name, run):
        start = time.perf_counter()
        result = run()
        seconds[name] = round(time.perf_counter() - start, 2)
        return result

    months = [(2024, m) for m in (1, 2, 3)]
    timed("land", lambda: landing.land(spark, f"{root}/deliveries", layout, months, spec=IngestSpec()).collect())
    counts = timed("silver", lambda: medallion.build_silver(spark, layout))
    timed("gold", lambda: medallion.build_gold(spark, layout))
    timed("load", lambda: [medallion.load_table(spark, layout, t) for t in medallion.LOAD_SOURCES])
    mart = timed("mart", lambda: medallion.refresh_mart(spark, layout, datetime.now(timezone.utc)).count())
    size = {layer: tables.path_bytes(spark, f"{root}/lake/{layer}") for layer in ("bronze", "silver", "gold")}
    print(json.dumps({"seconds": seconds, "total": round(sum(seconds.values()), 2), "rows": counts, "mart_rows": mart,
                      "bytes": size, "silver_rows_per_sec": round(counts["rows_in"] / seconds["silver"])}))
    spark.stop()


if __name__ == "__main__":
    main()
