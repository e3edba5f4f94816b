"""Series side by side: the plan of the features, and values that do not depend on how panels and tables are cut."""
import re

import numpy as np
import pyarrow as pa
import pytest

from barsight.operators import panel
from barsight.operators.indicators import FEATURES, feature_set
from tests.sequential import features as sequential
from tests.test_indicators import close_enough, frame, make_bars

LENGTHS = [1, 260, 13, 450, 50, 2]


def table_of(lengths):
    bars = [make_bars(n, ticker=f"L{n}", seed=n) for n in lengths]
    for i in (3, 40, 41, 255, 300):
        bars[3][i]["volume"] = None
    rows = [r for b in bars for r in b]
    return bars, pa.table({c: pa.array([r[c] for r in rows], pa.float64()) for c in ("high", "low", "close", "volume")})


@pytest.mark.parametrize("cells", [1, 500, 1 << 17])
def test_panels_of_any_size_equal_the_sequential_contract(monkeypatch, cells):
    monkeypatch.setattr(panel.side_by_side, "__defaults__", (cells,))
    bars, table = table_of(LENGTHS)
    got = panel.series_features(table, np.concatenate([np.arange(n) for n in LENGTHS]), [*FEATURES, "atrr_3"])
    want = [w for b in bars for w in sequential(b)]
    for name in (*FEATURES, "atrr_3"):
        for i, w in enumerate(want):
            x = None if np.isnan(got[name][i]) else got[name][i]
            assert close_enough(x, w[name]), (name, i, x, w[name])
    assert got["n_bars"].tolist() == [n for n in LENGTHS for _ in range(n)]


@pytest.mark.parametrize("size,rows", [(1, 1), (7, 20), (100, 300), (1000, 10)])
def test_tables_end_with_a_series(size, rows):
    rn = np.concatenate([np.arange(n) for n in LENGTHS])
    batches = pa.table({"rn": rn}).to_batches(max_chunksize=size)
    tables = list(panel.whole_series(batches, lambda b: np.asarray(b.column("rn")) == 0, rows))
    assert np.concatenate([np.asarray(t["rn"]) for t in tables]).tolist() == rn.tolist()
    assert all(t["rn"][0].as_py() == 0 for t in tables)
    assert all(t.num_rows <= max(rows, size) + max(LENGTHS) for t in tables)


def test_the_features_take_one_exchange_and_one_window_pass(spark):
    plan = feature_set(frame(spark, make_bars(30)))._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"\bWindow\b", plan)) == 1 and "MapInArrow" in plan


def test_the_stored_split_of_the_metrics_holds_no_feature(spark):
    from barsight.registry.spark_side import split_f9
    assert not set(split_f9(spark, "/root/testdata/sf0.001").columns) & set(FEATURES)
