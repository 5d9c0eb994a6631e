"""An extension: page files that keep arriving, through the same plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trawl.plans import pipeline
from trawl.scratch import page_batches


def page_stream(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """Rows of url and html from the Parquet files that appear in a folder."""
    return spark.readStream.schema("url string, html string").option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def ingest(pages: DataFrame, output: str, checkpoint: str, records: DataFrame | None = None) -> StreamingQuery:
    """Append the metadata of arriving pages to `output`, a folder for each batch, each once."""
    from pyspark.sql import functions as F

    def write(batch: DataFrame, n: int) -> None:
        docs = pipeline.enriched(pipeline.parsed_text(batch.withColumn("index_level", F.lit(2))), records)
        with page_batches(docs):
            pipeline.index_text(docs).write.mode("overwrite").parquet(f"{output}/batch={n}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
