"""Exchange / sort / window counts of the headline plans (AQE off so the
whole physical plan is visible before execution).

usage: python tools/plan_stats.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stats(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "exchanges": len(re.findall(r"Exchange (hash|range|single|round)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "sorts": plan.count("Sort ["),
        "windows": plan.count("Window ["),
        "window_group_limits": plan.count("WindowGroupLimit"),
        "reused_exchanges": plan.count("ReusedExchange"),
        "scans": plan.count("FileScan"),
    }


def main() -> None:
    from barsight.registry import spark_side as Q
    from barsight.session import build_session
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.sql.adaptive.enabled": "false"})
    heads = {
        "feature_set": Q.features_f1,
        "daily_picks": Q.q_daily_picks,
        "service_rows": Q.q_service_rows,
        "price_history_asof": Q.q_price_history_asof,
        "merge_upsert": Q.q_merge_upsert,
        "backfill_forward_window": Q.q_backfill_forward_window,
        "latest_per_key": Q.q_latest_per_key,
        "list_missing_work": Q.q_list_missing_work,
        "decode_messages": Q.q_decode_messages,
    }
    for name, fn in heads.items():
        print(json.dumps({"query": name, **stats(fn(spark, root))}))


if __name__ == "__main__":
    main()
