"""K3 and K4: work items go out as messages at a stated rate.

Items wait in an outbox as files of at most ``per_file`` items.  The emitting
stream admits one file for each trigger, every ``per_file / items_per_second``
seconds, and appends it to the topic folder that a consumer streams from.  A
trigger that ran over its time is followed at once by one more, so in any span of
``n`` periods no more than ``n + 1`` files go out.  Both sides are file streams with a commit
log, so an item goes out once, also when a trigger is replayed after a failure.
For higher rates, take larger files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# Fixed value: messages per second.
ITEMS_PER_SECOND = 10.0
#: Files of a trigger where no rate is held.
FILES_AT_ONCE = 200


def fill_outbox(items: DataFrame, outbox: str, per_file: int) -> None:
    """K3: the items as JSON files of at most ``per_file`` each; no item, no file."""
    if per_file < 1:
        raise ValueError("a file holds at least one item")
    items.write.option("maxRecordsPerFile", per_file).mode("append").json(outbox)


def start_emission(spark: SparkSession, outbox: str, topic: str, checkpoint: str, schema: StructType, per_file: int,
                   items_per_second: float = ITEMS_PER_SECOND, available_now: bool = False) -> StreamingQuery:
    """K4: a file of the outbox for each trigger.  ``available_now`` sends what is
    there without waiting, so at no rate, and ends: then a trigger admits
    ``FILES_AT_ONCE`` files, as its time does not depend on their number."""
    if items_per_second <= 0:
        raise ValueError("the rate must be positive")
    files = FILES_AT_ONCE if available_now else 1
    out = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(outbox).writeStream
           .format("json").option("path", topic).option("checkpointLocation", checkpoint))
    pause = max(1, round(1000 * per_file / items_per_second))
    return (out.trigger(availableNow=True) if available_now else out.trigger(processingTime=f"{pause} milliseconds")).start()
