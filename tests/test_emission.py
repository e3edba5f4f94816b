"""Work items leave the outbox at the stated rate, each once."""
import datetime as dt

import pytest

from barsight.streaming.emission import fill_outbox, start_emission


def test_no_trigger_sends_more_than_its_items(spark, tmp_path):
    items = spark.range(25).selectExpr("concat('K', id) AS key", "id")
    fill_outbox(items.coalesce(1), f"{tmp_path}/outbox", 10)
    args = (spark, f"{tmp_path}/outbox", f"{tmp_path}/topic", f"{tmp_path}/ck", items.schema, 10)
    q = start_emission(*args, items_per_second=10.0)
    q.processAllAvailable()
    sent = [p for p in q.recentProgress if p["numInputRows"]]
    q.stop()
    assert [p["numInputRows"] for p in sent] and max(p["numInputRows"] for p in sent) <= 10
    assert sum(p["numInputRows"] for p in sent) == 25
    at = [dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")) for p in sent]
    assert all((at[j] - at[i]).total_seconds() >= (j - i - 1) * 0.99 for i in range(len(at)) for j in range(i, len(at)))
    fill_outbox(items.where("id < 3"), f"{tmp_path}/outbox", 10)          # a later run sends only what is new
    start_emission(*args, available_now=True).awaitTermination()
    topic = spark.read.schema(items.schema).json(f"{tmp_path}/topic")
    assert topic.count() == 28 and topic.distinct().count() == 25


def test_bad_rates(spark, tmp_path):
    with pytest.raises(ValueError):
        fill_outbox(spark.range(1), f"{tmp_path}/outbox", 0)
    with pytest.raises(ValueError):
        start_emission(spark, f"{tmp_path}/a", f"{tmp_path}/b", f"{tmp_path}/c", spark.range(1).schema, 1, items_per_second=0)


def test_what_is_there_goes_out_in_few_triggers(spark, tmp_path):
    items = spark.range(60).selectExpr("concat('K', id) AS key", "id")
    fill_outbox(items.coalesce(1), f"{tmp_path}/outbox", 2)
    q = start_emission(spark, f"{tmp_path}/outbox", f"{tmp_path}/topic", f"{tmp_path}/ck", items.schema, 2, available_now=True)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 1
    assert spark.read.schema(items.schema).json(f"{tmp_path}/topic").distinct().count() == 60
