"""Streaming forms of batch operators. These go beyond the batch pipeline's features and are labelled as such in the README."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citelake.operators.delivery import DeliveryStore
from citelake.sources.cursor_pages import CursorPages


def page_stream(spark: SparkSession, url: str, **options: object) -> DataFrame:
    """Pages of a cursor-paged interface as a stream."""
    spark.dataSource.register(CursorPages)
    return spark.readStream.format("cursor_pages").options(url=url, **options).load()


def land_pages(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Pages to parquet, exactly once per checkpoint."""
    return pages.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()


def first_deliveries(messages: DataFrame, identifier: str, time: str, delay: str = "10 days") -> DataFrame:
    """The first message of each identifier within the watermark's delay; state older than that is dropped."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark([identifier])


def counts_by_period(messages: DataFrame, key: str, time: str, period: str = "1 day", delay: str = "10 days") -> DataFrame:
    """Messages per key and tumbling period, final once the watermark has passed."""
    return messages.withWatermark(time, delay).groupBy(F.window(time, period), key).agg(F.count("*").alias("n_messages")).select("window.start", "window.end", key, "n_messages")


def merge_stream(messages: DataFrame, store: DeliveryStore, checkpoint: str) -> StreamingQuery:
    """Each micro-batch goes into the store under its number, so a batch run again after a failure changes nothing."""
    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: store.merge(df, f"batch-{n}")).start()
