"""Sinks: assembled documents as JSON lines, to Kafka or to files; dead letters; and the document store."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.documents import merged


def as_json(documents: DataFrame, emit_update_count: bool = False) -> DataFrame:
    """``value``: the merged view of each document as a JSON string; nulls in it are kept."""
    count = F.col("boomerang_update_count") if emit_update_count else None
    return documents.select(F.to_json(merged(F.col("original_payload"), F.col("document_id"), F.col("timestamp"), F.col("enrichments"), count), {"ignoreNullFields": "false"}).alias("value"))


def write(values: DataFrame, checkpoint: str, bootstrap: str = "", topic: str = "", folder: str | None = None, trigger: str = "1 second"):
    """Start a streaming sink of a ``value`` column: a Kafka topic, or a folder of text files. At least once."""
    writer = values.select("value").writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger)
    if folder is None:
        return writer.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).start()
    return writer.format("text").option("path", folder).outputMode("append").start()


def drain(query, idle_seconds: float, poll_seconds: float = 0.5) -> None:
    """Stop a query once it has had no input for that long; its joiner's timeout should be within it.

    A query with processing-time timers never runs dry by itself, so OFFLINE mode ends like this.
    """
    seen, since = -1, time.monotonic()
    while query.isActive and time.monotonic() - since < idle_seconds:
        progress = query.lastProgress
        if progress is None or progress["numInputRows"] > 0 and progress["batchId"] != seen:
            seen, since = progress["batchId"] if progress else seen, time.monotonic()
        time.sleep(poll_seconds)
    query.stop()


def write_batch(values: DataFrame, bootstrap: str = "", topic: str = "", folder: str | None = None) -> None:
    if folder is None:
        values.select("value").write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()
    else:
        values.select("value").write.mode("append").text(folder)


def upsert(store: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """The store with documents replaced or added by key."""
    return store.join(documents.select(key), key, "left_anti").unionByName(documents)


