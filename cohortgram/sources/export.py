"""Report output. Report keys do not name their window, so files are kept apart by window start."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The CSV writer trims text unless told not to.
EXACT_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
FULL_RELEASE = "full_release"
WINDOW_PARTITION = "report_window"


def export_mart(mart: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write one report next to the windows already there.

    Only the partition of this report's own window is replaced; the window columns stay in the files.
    """
    label = F.coalesce(F.col("analysis_window_start").cast("string"), F.lit(FULL_RELEASE))
    writer = (
        mart.withColumn(WINDOW_PARTITION, label)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(WINDOW_PARTITION)
    )
    if fmt == "csv":
        writer = writer.options(header=True, **EXACT_TEXT)
    writer.format(fmt).save(path)


def write_csv(frame: DataFrame, path: str) -> None:
    """One report as CSV part files, written by the executors."""
    frame.write.mode("error").options(header=True, **EXACT_TEXT).csv(path)
