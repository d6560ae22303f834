"""Load each landed file once, however often the load runs."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortgram.sources.raw import CHECKED_HEADER, CSV_OPTIONS, file_schema


def load_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    version: str,
    table_path: str,
    progress_path: str,
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> StreamingQuery:
    """Append the files not loaded yet to a Parquet table and stop.

    The stream's progress log under ``progress_path`` is what remembers loaded files, so the table is not
    read to find out. Columns are taken by the header of the landed files, which have one layout in common. A malformed
    record, or a file with another header, fails its batch, which is retried whole on the next run.
    """
    found = file_schema(spark, landing, schema, multi_line)
    reader = spark.readStream.schema(found).options(**CSV_OPTIONS, **CHECKED_HEADER, multiLine=multi_line)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(landing).select(
        *schema.fieldNames(),
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(version).alias("source_version"),
        F.current_timestamp().alias("ingested_at"),
    )
    return (
        rows.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
