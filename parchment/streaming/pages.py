"""Pages that arrive in a folder: cut into records as they come, volumes stitched when their pages are in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.segmentation import resolve_partials, segment_pages, stitch

PAGES = "volume string, page_no bigint, image string, text string"


def page_stream(spark: SparkSession, folder: str, files_at_once: int = 100) -> DataFrame:
    """Segmented pages from JSONL files (volume, page_no, image, text) as they arrive; a page needs no other, so no state is held."""
    raw = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_at_once).json(folder)
    return segment_pages(raw)


def stitched_stream(pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append segmented pages to ``target``/pages and, after each micro-batch, write the records of the volumes it touched to
    ``target``/records/batch=n, stitched over all their pages so far; the last batch of a volume holds."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{target}/pages/batch={number}")
        touched = batch.select("volume").distinct()
        every = spark.read.schema(batch.schema).parquet(f"{target}/pages").drop("batch")
        own = every.join(touched, "volume", "left_semi").dropDuplicates(["volume", "page_no"])
        resolve_partials(stitch(own), own).write.mode("overwrite").parquet(f"{target}/records/batch={number}")

    return pages.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
