"""Histories as stretches of one stream: cut by any batches, and no sorted or gathered copies."""
import datetime as dt
import re

import numpy as np
import pyarrow as pa
import pytest

from barsight.operators.asof import asked_stretches, history_asof
from barsight.plans.scoring import service_rows
from tests.test_indicators import frame, make_bars


@pytest.mark.parametrize("size", [1, 3, 50])
def test_stretches_do_not_depend_on_the_batches(size):
    rows, end = [], -1
    for i in range(40):                                  # two tickers; every third row asks, the first before any bar
        end = -1 if i in (0, 20) else end
        asks = i % 3 == 0 or i == 20
        end += not asks
        rows.append({"t": i // 20, "target_date": i if asks else None, "_end": end, "v": None if asks else i})
    table = pa.Table.from_pylist(rows, schema=pa.schema([("t", pa.int64()), ("target_date", pa.int64()), ("_end", pa.int64()), ("v", pa.int64())]))
    got = {}
    for asked, bars, starts, lengths in asked_stretches(table.to_batches(max_chunksize=size), 5):
        assert bars.num_rows <= 5 + size
        for key, s, n in zip(asked["target_date"].to_pylist(), starts, lengths):
            got[key] = bars["v"].to_pylist()[s:s + n]
    want = {r["target_date"]: [x["v"] for x in rows[:i] if x["t"] == r["t"] and x["v"] is not None][-5:]
            for i, r in enumerate(rows) if r["target_date"] is not None}
    assert got == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("plan_of", [history_asof, service_rows])
def test_the_copies_of_a_history_are_not_sorted(spark, plan_of):
    bars = frame(spark, make_bars(90))
    asked = spark.createDataFrame([("T", dt.date(2021, 6, 1))], "ticker string, date date")
    plan = plan_of(bars, asked)._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"\bWindow\b", plan)) == 1 and "Generate" not in plan
    assert np.size(plan_of(bars, asked).collect()) > 0
