"""Where relations with many readers are kept.

They are written as Parquet below the shared folder the session names in ``spark.checkpoint.dir``. That
cuts lineage, survives lost executors, and gives later scans column pruning and filter pushdown.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Codec of stored relations: keys are hashes in hex, which only entropy coding halves.
CODEC = "zstd"
#: What they are written with: on sorted buckets level 1 takes as much room as the default of 3, and pages without dictionaries 5 % more
#: than with them, for 8 % less CPU time of the whole build.
CODEC_OPTIONS = {"compression": CODEC, "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}
#: Most rows of a file, so that a scan can be split.
FILE_ROWS = 1_000_000
#: Source rows of a bucket. What is rolled up from them is sorted in memory: measured peak 130 MB a task at 150,000 rows.
BUCKET_ROWS = 150_000
#: Rows a task takes from a stored relation to deal them out. Files hold a few bytes a row, tasks some hundred: beyond
#: ``spark.shuffle.sort.bypassMergeThreshold`` partitions they are all held, 285 MB of a million raw rows.
DEALT_ROWS = 500_000
SPLITS_SETTING = "spark.sql.files.minPartitionNum"
#: Off, lists are collected from sorted rows. On, a task sorts what it has left after 128 groups, before and again after its partials.
OBJECT_HASH_SETTING = "spark.sql.execution.useObjectHashAggregateExec"


def scratch_root(spark: SparkSession) -> str:
    """The configured folder, which every executor must reach. There is no other place to fall back to."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if not configured:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    return configured


class Scratch:
    """Named Parquet tables of one run, each run in a folder of its own that goes when the session's JVM ends.

    ``counts`` given with a relation are aggregates that are taken from its rows as they are written, without a scan of their own;
    ``counted`` holds them by relation. They are observed in the tasks that write the files, of which Spark counts one attempt each,
    so lost executors do not count rows twice.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.counted: dict[str, dict[str, int]] = {}
        self.path = f"{(root or scratch_root(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"
        # Relations that lie by one key of a join are joined as they lie, whatever more keys the join has.
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self._forget_at_exit()

    def _forget_at_exit(self) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path(self.path)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    @property
    def buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def buckets_for(self, rows: int) -> int:
        """Buckets of relations rolled up from so many rows: no task gets more than memory holds, however many there are."""
        return max(self.buckets, -(-rows // BUCKET_ROWS))

    @contextmanager
    def splits_for(self, rows: int) -> Iterator[None]:
        """Inside, scans of files with so many rows are split into tasks of about ``DEALT_ROWS``, as shuffles buffer what they deal out."""
        before = self.spark.conf.get(SPLITS_SETTING, None)
        least = max(self.spark.sparkContext.defaultParallelism, -(-rows // DEALT_ROWS), int(before or 0))
        with self._setting(SPLITS_SETTING, str(least)):
            yield

    @contextmanager
    def _setting(self, name: str, value: str) -> Iterator[None]:
        before = self.spark.conf.get(name, None)
        self.spark.conf.set(name, value)
        try:
            yield
        finally:
            self.spark.conf.unset(name) if before is None else self.spark.conf.set(name, before)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def keep(
        self, name: str, frame: DataFrame, rows: int | None = None, counts: Mapping[str, Column] | None = None
    ) -> DataFrame:
        """Writes a relation and reads it back. ``rows``, if an upper bound is known, keeps it to few files."""
        if rows is not None:
            frame = frame.repartition(max(1, -(-rows // FILE_ROWS)))
        seen, frame = _observed(frame, counts)
        writer = frame.write.mode("error").options(**CODEC_OPTIONS).option("maxRecordsPerFile", FILE_ROWS)
        writer.parquet(self.folder(name))
        self._take(name, seen)
        return self.spark.read.schema(frame.schema).parquet(self.folder(name))

    def keep_by(
        self, name: str, frame: DataFrame, key: str, counts: Mapping[str, Column] | None = None, buckets: int | None = None
    ) -> DataFrame:
        """Writes a relation as a table of buckets of ``key``, sorted by it, and reads it back: one per shuffle partition or ``buckets``.

        Its rows are shuffled once, here; joins and aggregations on ``key`` then read the buckets as they lie. Meant for relations
        with a bounded number of rows per key. The table is known to the session's catalog under a name of its own, which is dropped when the
        program ends.
        """
        buckets, table = buckets or self.buckets, f"kept_{uuid.uuid4().hex}"
        # Spark leaves this shuffle out if the rows already lie by the key in as many partitions.
        seen, dealt = _observed(frame.repartition(buckets, key), counts)
        writer = dealt.write.format("parquet").mode("error").option("path", self.folder(name))
        writer = writer.options(**CODEC_OPTIONS)
        with self._setting(OBJECT_HASH_SETTING, "false"):
            writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        self._take(name, seen)
        atexit.register(_drop, self.spark, table)
        return self.spark.table(table)

    def _take(self, name: str, seen: Observation | None) -> None:
        if seen is not None:
            self.counted[name] = dict(seen.get)


def _observed(frame: DataFrame, counts: Mapping[str, Column] | None) -> tuple[Observation | None, DataFrame]:
    if not counts:
        return None, frame
    seen = Observation()
    return seen, frame.observe(seen, *[aggregate.alias(name) for name, aggregate in counts.items()])


def _drop(spark: SparkSession, table: str) -> None:
    if spark.sparkContext._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
