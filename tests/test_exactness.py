"""Long flat runs, dirty prices, duplicated bars, bad requests, missing artifacts."""
import datetime as dt
import json

from pyspark.sql import functions as F

from barsight.operators.indicators import FEATURES, feature_set
from barsight.operators.model import load_threshold
from barsight.plans.ingestion import merge_tables
from barsight.plans.scoring import latest_valid
from barsight.sources import versioned
from barsight.sources.prices import scan_prices
from barsight.streaming.pipelines import publish_json, start_feature_stream
from tests.sequential import features as seq_features
from tests.test_indicators import close_enough, frame, make_bars


def test_ratios_stay_right_after_long_flat_runs(spark):
    bars = make_bars(900, seed=4)
    for b in bars[200:]:
        b.update(open=50.0, high=51.0, low=49.0, close=50.0, volume=10.0)
    got = feature_set(frame(spark, bars)).orderBy("date").collect()
    want = seq_features(bars)
    for i in (199, 300, 511, 512, 700, 899):
        for name in ("rsi_5", "rsi_14", "adx_14", "atr_ratio", "ema_50"):
            assert close_enough(got[i][name], want[i][name], rel=1e-7), (i, name)
    assert got[899]["rsi_5"] is not None


def test_a_missing_price_spoils_no_more_than_its_window(spark):
    bars = make_bars(300, seed=6)
    raw = frame(spark, bars).withColumnRenamed("close", "adj_close")
    nan = raw.withColumn("volume", F.when(F.col("date") == bars[150]["date"], F.lit(float("nan"))).otherwise(F.col("volume")))
    bad = raw.withColumn("adj_close", F.when(F.col("date") == bars[150]["date"], F.lit(float("inf"))).otherwise(F.col("adj_close")))
    assert scan_prices(bad).count() == 299
    rows = feature_set(scan_prices(nan)).where("rvol_20 IS NULL OR isnan(rvol_20)").count()
    assert rows == 19 + 20


def test_one_newest_row_per_series(spark):
    rows = [("A", dt.date(2024, 1, 1), 1.0), ("A", dt.date(2024, 1, 2), 2.0), ("A", dt.date(2024, 1, 2), 3.0), ("B", None, 1.0)]
    got = latest_valid(spark.createDataFrame(rows, "ticker string, date date, close double")).collect()
    assert sorted((r.ticker, r.close) for r in got) == [("A", 3.0), ("B", 1.0)]


def test_a_bad_date_does_not_stop_the_stream(spark, tmp_path):
    prices = frame(spark, make_bars(80))
    day = make_bars(80)[79]["date"].isoformat()
    rows = spark.createDataFrame([("T", day), ("T", "2024-13-45"), (None, day)], "ticker string, date string")
    publish_json(rows, f"{tmp_path}/in")
    start_feature_stream(spark, prices, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    out = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert len(out) == 1 and set(FEATURES) <= set(out[0]) and out[0]["sma_200"] is None


def test_only_a_missing_threshold_is_the_default(spark, tmp_path):
    one = spark.range(1)
    assert one.select(load_threshold(spark, f"{tmp_path}/none")).first()[0] == 0.5
    spark.createDataFrame([(0.7,)], "threshold double").write.json(f"{tmp_path}/run/threshold")
    assert one.select(load_threshold(spark, f"{tmp_path}/run")).first()[0] == 0.7


def test_merge_of_tables_reports_counts(spark, tmp_path):
    from barsight.sources import fixtures as FX
    root = "/root/testdata/sf0.001"
    final, staging = f"{tmp_path}/final", f"{tmp_path}/staging"
    versioned.write_next(FX.final_features(spark, root), final)
    versioned.write_next(FX.staging_features(spark, root), staging)
    kwargs = dict(strict=FX.FEATURE_STRICT, soft=FX.FEATURE_SOFT, gate=False)
    first = merge_tables(spark, final, staging, **kwargs)
    assert first["status"] == "merged" and sum(first["counts"].values()) > 0
    rows = versioned.read_current(spark, final)
    again = merge_tables(spark, final, staging, truncate_staging=True, **kwargs)
    assert again["staging_truncated"] and versioned.read_current(spark, staging).count() == 0
    assert rows.exceptAll(versioned.read_current(spark, final)).count() == 0
    assert merge_tables(spark, final, staging, **kwargs)["status"] == "empty_staging"


def test_a_feature_plan_changes_no_setting(spark):
    fresh = spark.newSession()
    before = fresh.conf.getAll
    assert feature_set(fresh.createDataFrame(frame(spark, make_bars(60)).collect(), frame(spark, []).schema)).count() == 60
    assert fresh.conf.getAll == before
