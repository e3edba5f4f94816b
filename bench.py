"""Headline-query benchmark.

Runs the main plans on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is executed to
completion through the no-op sink (all rows produced, nothing collected); the
first run of each query is a warm-up for JIT and code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barsight.session import build_session  # noqa: E402
from barsight.registry import spark_side as Q  # noqa: E402

HEADLINE = {
    "feature_set": Q.features_f1,
    "daily_picks": Q.q_daily_picks,
    "service_rows": Q.q_service_rows,
    "merge_upsert": Q.q_merge_upsert,
    "backfill_forward_window": Q.q_backfill_forward_window,
    "chrono_split": Q.q_chrono_split,
    "average_precision": Q.q_average_precision,
    "decode_messages": Q.q_decode_messages,
    "price_history_asof": Q.q_price_history_asof,
}


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]")
    times, rows = {}, {}
    for name, fn in HEADLINE.items():
        fn(spark, root).write.format("noop").mode("overwrite").save()
        t0 = time.time()
        df = fn(spark, root)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    bars = Q.prices_f1(spark, root).count()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(root.rstrip("/")).replace("sf", ""), "cpus": int(cpus),
                      "weekly_bars": bars,
                      "feature_rows_per_sec": round(bars / times["feature_set"], 1)}))


if __name__ == "__main__":
    main()
