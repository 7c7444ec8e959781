"""Follow folders of CSV deliveries and publish a version per micro-batch.

The stream only tells which files are new; each micro-batch goes through the same staging, checks
and publication as a batch. Its number is written into the version's manifest, so a micro-batch that
is run again after a failure changes nothing if it was published, and starts over if it was not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starloom.plans.append import append_staged
from starloom.schemas import Feed
from starloom.sources.feeds import stage_feed, stage_lines, text_lines


def publish_batch(lines: DataFrame, feed: Feed, root: str, batch: str) -> dict:
    """Publish the version after the ``lines`` of one feed, once per ``batch``."""
    def stage(other: Feed, folder: str) -> int:
        if other is feed:
            return stage_lines(lines, feed, folder)
        return stage_feed(lines.sparkSession, None, other, folder)
    return append_staged(lines.sparkSession, stage, root, batch)


def follow(spark: SparkSession, folder: str, feed: Feed, root: str, checkpoint: str,
           files_per_batch: int = 100) -> StreamingQuery:
    """Publish what arrives in ``folder`` until no more is there; run again to go on.

    A file must be complete when it appears, and starts with a header. ``checkpoint`` names the
    stream: the same one must be used again to go on with it.
    """
    lines = text_lines(spark.readStream.option("maxFilesPerTrigger", files_per_batch), folder)

    def publish(batch: DataFrame, number: int) -> None:
        publish_batch(batch, feed, root, f"{checkpoint}#{number}")

    return (lines.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
