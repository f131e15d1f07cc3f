"""Facts kept up to date by a stream over the final records of the commit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upsert import Facts
from tidemark.sources.store import Store

_FINAL = "run_id string, knowledge_at string, completed_at string"


def follow(spark: SparkSession, store: Store, facts: Facts, product: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Builds the product's fact whenever commits have been finalised.

    The source follows final records, which are written whole and after all that a commit consists of: a commit
    that still waits for its record wakes nothing, and its record does once it is there. Which rows count is
    decided by the log and the fact's own mark, so a batch that is replayed does no harm. Late events are never
    dropped, hence no watermark.
    """
    store.files.create("log/_followed", "")
    finals = spark.readStream.schema(_FINAL).option("pathGlobFilter", "*.final.json").json(store.files.path("log"))

    def bring_up_to_date(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            facts.build(store, product)

    writer = finals.writeStream.foreachBatch(bring_up_to_date).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
