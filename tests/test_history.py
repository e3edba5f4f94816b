"""As-of histories over blocks: against a plain loop and the window plan."""
import datetime as dt
import random

import pytest

from barsight.operators import asof
from barsight.operators.history import history_asof, pruned_bars, distinct_requests

DAY = dt.date(2020, 1, 1)


def bars_of(spark, counts, seed=1):
    rng = random.Random(seed)
    rows = []
    for t, n in counts.items():
        d = DAY
        for i in range(n):
            d += dt.timedelta(days=rng.randint(1, 3))
            rows.append((t, d, 1.0 + i, 2.0 + i, 0.5 + i, None if rng.random() < 0.02 else 1.5 + i, float(i)))
    return rows, spark.createDataFrame(rows, "ticker STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE")


def brute(rows, asked, limit):
    out = []
    for t, d in {(t, d) for t, d in asked if t is not None and d is not None}:
        own = sorted(r[1:] for r in rows if r[0] == t and r[5] is not None and r[1] <= d)
        out += [(t, d, *r) for r in own[-limit:]]
    return sorted(out)


@pytest.mark.parametrize("limit,most", [(7, 1000), (40, 2), (300, 1000)])
def test_histories_equal_a_loop_for_a_request_on_every_bar(spark, limit, most):
    rows, bars = bars_of(spark, {"a": 150, "b": 3, "c": 41, "d": 40, "e": 1})
    asked = [(r[0], r[1] + dt.timedelta(days=k)) for r in rows for k in (0, 1)]
    asked += [("a", DAY - dt.timedelta(days=9)), ("zz", DAY), (None, DAY), ("a", None), ("a", dt.date(2030, 1, 1))]
    requests = spark.createDataFrame(asked, "ticker STRING, date DATE")
    got = sorted(map(tuple, history_asof(bars, requests, limit, most=most).collect()))
    assert got == brute(rows, asked, limit)
    assert got == sorted(map(tuple, asof.history_asof(bars, requests, limit).collect()))
    one = history_asof(bars, requests, limit, most=most, exploded=False).collect()
    assert sum(len(r.bars) for r in one) == len(got) and max(len(r.bars) for r in one) <= limit


def test_empty_sides(spark):
    rows, bars = bars_of(spark, {"a": 5})
    none = spark.createDataFrame([], "ticker STRING, date DATE")
    assert history_asof(bars, none, 3).count() == 0
    assert history_asof(bars.where("false"), spark.createDataFrame([("a", DAY)], "ticker STRING, date DATE"), 3).count() == 0


def test_the_scan_reads_only_the_tickers_and_dates_asked_for(spark, tmp_path):
    _, bars = bars_of(spark, {f"t{i}": 30 for i in range(20)})
    bars.write.parquet(f"{tmp_path}/bars")
    asked = distinct_requests(spark.createDataFrame([("t3", dt.date(2020, 1, 20)), ("t4", dt.date(2020, 1, 9))], "ticker STRING, date DATE"))
    kept = pruned_bars(spark.read.parquet(f"{tmp_path}/bars"), asked)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(date,2020-01-20)" in plan and ("In(ticker, [t3,t4])" in plan or "In(ticker, [t4,t3])" in plan)
    assert {r.ticker for r in kept.select("ticker").distinct().collect()} == {"t3", "t4"}
