"""Pages as a stream: new pages become parts; late pages are counted by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioflow.functions import text as t


def page_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Parquet files of pages as they arrive."""
    return spark.readStream.schema(schema).parquet(folder)


def stream_parts(pages: DataFrame, late: str = "30 days") -> DataFrame:
    """(doc_id, page, ord, id, marks, text) of each new page once; a page delivered again within `late` is dropped by its key."""
    once = pages.withColumn("at", F.col("loaded_at").cast("timestamp")).withWatermark("at", late).dropDuplicatesWithinWatermark(["page_id"])
    rows = once.filter(~t.is_front_matter(F.col("markdown"))).select("doc_id", "page", "at", F.posexplode(t.prose_parts(t.clean_junk(F.col("markdown")))).alias("i", "q"))
    return rows.select("doc_id", "page", "at", (F.col("i") + 1).alias("ord"), "q.id", "q.marks", "q.text")


def parts_by_day(parts: DataFrame) -> DataFrame:
    """Parts and marks by day of arrival, on the watermark of the stream."""
    return parts.groupBy(F.window("at", "1 day").alias("w")).agg(F.count("*").alias("parts"), F.sum(F.coalesce("marks", F.lit(0))).alias("marks")).select(F.col("w.start").alias("day"), "parts", "marks")


def write_stream(df: DataFrame, folder: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Parquet sink that takes what is there and ends."""
    return df.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
