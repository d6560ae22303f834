"""A table of loaded files that each file enters exactly once, whatever dies on the way.

A load reads files the ledger lacks, writes their rows and their ledger entries (path, size, modification time, rows,
fingerprint) below a name of its own, and becomes visible by one atomic step: the rename of a small file to the next
number in ``commits``. Until then nothing of it counts, and a load that finds its number taken by another fails and leaves the table as it
was. So a load may end at any point and be run again, and of two at once one wins.

Names of files are listed by Spark and joined with the ledger in Spark. The reader of files wants their paths from the driver: it gets
at most ``files_per_load`` of them, and every such group is a commit of its own.

    rows/load=<name>/     rows of a load
    files/load=<name>/    its ledger entries
    commits/<number>      the name of the load that counts as this number
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgram.sources.raw import as_uri, load_raw

ENTRY = "source_file string, size_bytes long, modified_at timestamp, row_count long, fingerprint string"
#: Names of files on the driver at a time: a bound on its memory, not on a load.
FILES_PER_LOAD = 10_000


class CommitConflict(RuntimeError):
    """Another load has committed in between; nothing of this one counts."""


class LoadLedger:
    """A folder with rows, ledger entries and commits."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self._jvm = spark.sparkContext._jvm
        self._configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for part in ("rows", "files", "commits", "staged"):
            path = self._path(part)
            path.getFileSystem(self._configuration).mkdirs(path)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    # -- what counts -------------------------------------------------------------------------------
    def commits(self) -> DataFrame:
        """``number, load`` of the commits."""
        found = self.spark.read.schema("value string").text(f"{self.folder}/commits")
        return found.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).cast("long").alias("number"), F.col("value").alias("load"))

    def _committed(self, part: str, schema: str | T.StructType) -> DataFrame:
        wanted = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        stored = self.spark.read.schema(T.StructType([*wanted.fields, T.StructField("load", T.StringType())]))
        # With a condition on them, Spark takes the commits to the partitions of the scan: loads that do not count are not read.
        counted = self.commits().filter("number > 0").select("load")
        return stored.parquet(f"{self.folder}/{part}").join(counted, "load", "left_semi").drop("load")

    def files(self) -> DataFrame:
        """The ledger: an entry for every loaded file."""
        return self._committed("files", ENTRY)

    def rows(self) -> DataFrame:
        """The rows of all loaded files, as ``load_raw`` returns them."""
        lineage = [T.StructField("source_file", T.StringType()), T.StructField("source_version", T.StringType()), T.StructField("ingested_at", T.TimestampType())]
        return self._committed("rows", T.StructType([*self.schema.fields, *lineage]))

    # -- what is there to load ---------------------------------------------------------------------
    def listed(self, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
        """Every file below a path: ``source_file, path, size_bytes, modified_at``; none is opened."""
        found = self.spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(path)
        return found.select(
            as_uri("path").alias("source_file"), "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")
        )

    def new_files(self, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
        """The listed files whose names the ledger lacks."""
        return self.listed(path, pattern).join(self.files().select("source_file"), "source_file", "left_anti")

    def changed_files(self, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
        """Loaded files that are no longer what was loaded: another size or time. They are not loaded again."""
        was = self.files().select("source_file", F.col("size_bytes").alias("loaded_size_bytes"), F.col("modified_at").alias("loaded_modified_at"))
        now = self.listed(path, pattern).drop("path").join(was, "source_file")
        return now.filter((F.col("size_bytes") != F.col("loaded_size_bytes")) | (F.col("modified_at") != F.col("loaded_modified_at")))

    # -- loading -----------------------------------------------------------------------------------
    def load(
        self,
        path: str | list[str],
        version: str,
        pattern: str = "*.csv",
        multi_line: bool = False,
        files_per_load: int = FILES_PER_LOAD,
    ) -> list[str]:
        """Loads the new files below a path and returns the names of the loads, one per ``files_per_load`` files.

        A malformed record, or a file with another header than the first of its group, fails the load; groups before it count.
        """
        names = []
        while True:
            number = self.next_number()
            some = self.new_files(path, pattern).orderBy("source_file").limit(files_per_load).collect()
            if not some:
                return names
            names.append(self.stage([tuple(r) for r in some], version, multi_line))
            self.commit(names[-1], number)

    def next_number(self) -> int:
        """The number of the next commit, to be asked for before the new files are."""
        return (self.commits().agg(F.max("number")).first()[0] or 0) + 1

    def stage(self, files: list[tuple], version: str, multi_line: bool = False) -> str:
        """Writes rows and entries of files (as ``listed`` returns them) that do not count yet."""
        load = uuid.uuid4().hex
        staged = f"{self.folder}/rows/load={load}"
        load_raw(self.spark, [f[1] for f in files], self.schema, version, multi_line).write.mode("error").parquet(staged)
        read = self.spark.read.parquet(staged)
        found = read.groupBy(as_uri("source_file").alias("source_file")).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.xxhash64(*self.schema.fieldNames()).cast("decimal(20,0)")).cast("string").alias("fingerprint"),
        )
        listed = self.spark.createDataFrame(files, "source_file string, path string, size_bytes long, modified_at timestamp")
        entries = listed.drop("path").join(found, "source_file", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))
        entries.select([c.split()[0] for c in ENTRY.split(", ")]).coalesce(1).write.mode("error").parquet(f"{self.folder}/files/load={load}")
        return load

    def commit(self, load: str, number: int) -> None:
        """Makes a staged load count as ``number``, or fails if that number is taken."""
        staged, final = self._path(f"staged/{load}"), self._path(f"commits/{number:012d}")
        out = staged.getFileSystem(self._configuration).create(staged, True)
        out.write(bytearray(load.encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self._configuration)
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            # Without an option to overwrite, a rename to a name that exists fails.
            context.rename(staged, final, options)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise CommitConflict(f"{self.folder}: commit {number} is taken") from error
            raise

    def clear_staged(self, older_than_hours: float = 24.0) -> int:
        """Deletes what loads have left that never counted and are older than that; the number of loads."""
        known = {r.load for r in self.commits().collect()}
        files = self._path("rows").getFileSystem(self._configuration)
        before = self._jvm.java.lang.System.currentTimeMillis() - older_than_hours * 3_600_000
        gone = set()
        for part in ("rows", "files"):
            for status in files.listStatus(self._path(part)):
                name = status.getPath().getName()
                if name.startswith("load=") and name[5:] not in known and status.getModificationTime() <= before:
                    files.delete(status.getPath(), True)
                    gone.add(name)
        return len(gone)
