import datetime as dt

from pyspark.sql import functions as F

from barsight.operators.tables import (
    latest_per_key, merge_counts, merge_snapshot, merge_upsert, plan_backfill, backfill_source,
)
from barsight.plans.ingestion import run_merge

SCHEMA = ("ticker string, quarter_end_date date, earnings_call_date date, sector string, "
          "industry string, value double, load_seq bigint")
STRICT = ["ticker", "quarter_end_date", "earnings_call_date", "sector", "industry"]
SOFT = ["value"]
Q1, Q2 = dt.date(2024, 3, 31), dt.date(2024, 6, 30)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def final(spark):
    return rows(spark, [("A", Q1, dt.date(2024, 4, 20), "s", "i", 1.0, 1),
                        ("B", Q1, dt.date(2024, 4, 21), "s", "i", 2.0, 2),
                        (None, Q1, dt.date(2024, 4, 22), "s", "i", 3.0, 3)])


def staging(spark):
    return rows(spark, [
        ("A", Q1, dt.date(2024, 4, 25), "s", "i", 10.0, 10),   # newer duplicate wins
        ("A", Q1, dt.date(2024, 4, 24), "s", "i", 11.0, 11),
        ("A", Q1, None, "s", "i", 12.0, 12),                   # null date sorts last
        ("C", Q2, dt.date(2024, 7, 20), "s", "i", None, 13),   # insert
        ("D", Q2, dt.date(2024, 7, 21), "s", None, 5.0, 14),   # strict null: not inserted
        (None, Q1, dt.date(2024, 4, 22), "s", "i", 9.0, 15),   # null key never matches
    ])


def test_dedupe_newest_with_tie_break(spark):
    st = rows(spark, [("A", Q1, dt.date(2024, 4, 25), "s", "i", 1.0, 1),
                      ("A", Q1, dt.date(2024, 4, 25), "s", "i", 2.0, 2),
                      ("A", Q1, None, "s", "i", 3.0, 3)])
    out = latest_per_key(st).collect()
    assert len(out) == 1 and out[0]["load_seq"] == 2


def test_merge_actions_and_null_keys(spark):
    plan = merge_upsert(final(spark), staging(spark), strict=STRICT)
    c = merge_counts(plan).first().asDict()
    assert c == {"update": 1, "insert": 1, "skip": 2, "keep": 2, "affected": 2}
    snap = {(r["ticker"], r["quarter_end_date"]): r for r in merge_snapshot(plan).collect()}
    assert snap[("A", Q1)]["value"] == 10.0
    assert ("C", Q2) in snap and ("D", Q2) not in snap
    assert snap[(None, Q1)]["value"] == 3.0  # target's null-key row kept untouched


def test_merge_is_idempotent(spark):
    once = merge_snapshot(merge_upsert(final(spark), staging(spark), strict=STRICT))
    twice = merge_snapshot(merge_upsert(once, staging(spark), strict=STRICT))
    key = ["ticker", "quarter_end_date", "load_seq", "value"]
    assert sorted(map(tuple, once.select(key).collect()), key=repr) == \
        sorted(map(tuple, twice.select(key).collect()), key=repr)


def test_gate_sequence(spark):
    status, snap = run_merge(final(spark), staging(spark), strict=STRICT, soft=SOFT, gate=True)
    assert status == "aborted_strict_nulls" and snap.count() == 3
    status, _ = run_merge(final(spark), staging(spark).limit(0), strict=STRICT, soft=SOFT)
    assert status == "empty_staging"
    status, _ = run_merge(final(spark), staging(spark).dropna(subset=STRICT).drop("value"),
                          strict=STRICT, soft=[])
    assert status == "schema_mismatch"
    status, snap = run_merge(final(spark), staging(spark), strict=STRICT, soft=SOFT, gate=False)
    assert status == "merged" and snap.count() == 4


def test_backfill_modes(spark):
    feats = spark.createDataFrame(
        [("A", Q1, dt.date(2024, 1, 10), None), ("B", Q1, dt.date(2024, 1, 10), 7.0),
         ("C", Q1, dt.date(2024, 12, 30), None)],
        "ticker string, quarter_end_date date, earnings_call_date date, max_close_30d double")
    prices = spark.createDataFrame(
        [("A", dt.date(2024, 1, 10), 5.0), ("A", dt.date(2024, 1, 10), 6.0),
         ("A", dt.date(2024, 1, 20), 9.0), ("A", dt.date(2024, 2, 10), 99.0),
         ("B", dt.date(2024, 1, 10), 1.0), ("C", dt.date(2024, 12, 30), 1.0)],
        "ticker string, date date, adj_close double")
    as_of = "2024-12-31"
    coded = {r["ticker"]: r for r in plan_backfill(feats, backfill_source(feats, prices, as_of)).collect()}
    assert coded["A"]["max_close_30d"] == 6.0 and coded["A"]["_updated"]
    assert coded["B"]["max_close_30d"] == 7.0 and not coded["B"]["_updated"]  # not null: untouched
    assert coded["C"]["max_close_30d"] is None  # not matured
    fwd = {r["ticker"]: r for r in plan_backfill(
        feats, backfill_source(feats, prices, as_of, "forward_window")).collect()}
    assert fwd["A"]["max_close_30d"] == 9.0  # day 10 counts, day 31 does not
