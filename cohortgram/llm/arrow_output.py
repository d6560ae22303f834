"""Token ids of documents as Arrow IPC files of equal-length sequences, and their random-access reader.

A file holds record batches of two fixed-size lists of ``length`` values: ``ids`` and ``mask`` (false where the
last sequence of a file is padded). Value ``i`` of a file is in batch ``i // (length * ROWS)`` at a known place,
so a reader maps the file and slices it without copying or parsing. Beside each file lies a small one with
``doc_id, start, n_tokens`` of its documents; the manifest lists both and the number of ids before the file.

Documents are put in ascending ``doc_id`` order by a range shuffle of the texts; each task then encodes and
writes its range. Every attempt of a task writes under a name of its own and the manifest, a Parquet table
committed by Spark, names the files that count, so a task may run again at any time.

A null text is empty, a null ``doc_id`` comes first. Rows with equal ids follow each other in the order of a hash
of the text. No rows give an empty manifest. Columns besides ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortgram.llm import memory
from cohortgram.llm.text import parts
from cohortgram.llm.tokens import pieces
from cohortgram.plans.storage import Scratch

LENGTH = 2048
#: Sequences in a record batch.
ROWS = 256

MANIFEST = "part long, path string, docs_path string, n_tokens long, n_docs long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_sequences(
    docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int, vocabulary: int, length: int = LENGTH
) -> DataFrame:
    """Writes the files below the scratch folder and returns the manifest with ``first``, the ids before each file."""
    folder = scratch.folder("sequences")
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("arrow_output")
        part = TaskContext.get().partitionId()
        writer = None
        for batch in parts(rows):
            if writer is None:
                writer = _Writer(folder, part, kind, length)
            encoded = pieces(tokenizer).encode([t or "" for t in batch.column("text").to_pylist()])
            writer.add(batch.column("doc_id"), encoded, end_id)
        if writer is not None:
            yield writer.close()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    manifest = scratch.keep("manifest", ordered.mapInArrow(write, MANIFEST))
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class _Writer:
    def __init__(self, folder: str, part: int, kind: pa.DataType, length: int):
        self.name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        self.part, self.kind, self.length = part, kind, length
        files, path = pafs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sinks = [files.open_output_stream(f"{path}/{self.name.rsplit('/', 1)[1]}{s}") for s in (".arrow", ".docs")]
        self.sequences = pa.ipc.new_file(self.sinks[0], self.schema)
        self.documents = pa.ipc.new_file(self.sinks[1], _DOCS)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = self.count = 0

    def add(self, doc_ids: pa.Array, encoded: list[bytes], end_id: int) -> None:
        end = np.array([end_id], "<u4").tobytes()
        sizes = np.array([len(e) // 4 + 1 for e in encoded], np.int64)
        starts = self.total + np.cumsum(sizes) - sizes
        self.documents.write_batch(pa.record_batch([doc_ids, pa.array(starts), pa.array(sizes)], schema=_DOCS))
        self.total += int(sizes.sum())
        self.count += len(encoded)
        self.waiting.append(np.frombuffer(end.join(encoded) + end, "<u4").astype(self.kind.to_pandas_dtype()))
        self.held += len(self.waiting[-1])
        full = self.length * ROWS
        if self.held >= full:
            ids = np.concatenate(self.waiting)
            whole = self.held // full * full
            for start in range(0, whole, full):
                self._write(ids[start : start + full], full)
            self.waiting, self.held = [ids[whole:]], self.held - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        lists = [pa.FixedSizeListArray.from_arrays(a, self.length) for a in (pa.array(ids), mask)]
        self.sequences.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> pa.RecordBatch:
        if self.held:
            self._write(np.pad(np.concatenate(self.waiting), (0, -self.held % self.length)), self.held)
        for closing in (self.sequences, self.documents, *self.sinks):
            closing.close()
        values = [[self.part], [f"{self.name}.arrow"], [f"{self.name}.docs"], [self.total], [self.count]]
        return pa.record_batch(values, names=[c.split()[0] for c in MANIFEST.split(", ")])


class SequenceFile:
    """Random access to one file. Ids are views of the mapped file where it is a local one."""

    def __init__(self, path: str):
        files, inside = pafs.FileSystem.from_uri(path)
        local = isinstance(files, pafs.LocalFileSystem)
        self.reader = pa.ipc.open_file(pa.memory_map(inside) if local else files.open_input_file(inside))
        self.length = self.reader.schema.field("ids").type.list_size

    def batch(self, i: int) -> np.ndarray:
        return self.reader.get_batch(i).column("ids").values.to_numpy()

    def real(self) -> int:
        """Ids that are no padding."""
        masks = (self.reader.get_batch(i).column("mask").values for i in range(self.reader.num_record_batches))
        return sum(m.true_count for m in masks)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start``: a view, or a copy where they lie in several batches."""
        full, found = self.length * ROWS, []
        while count > 0:
            values = self.batch(start // full)
            at = start % full
            found.append(values[at : at + count])
            start, count = start + len(found[-1]), count - len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.empty(0, np.uint32)


def read_documents(manifest: DataFrame) -> DataFrame:
    """A row per document from the files: ``doc_id, start, n_tokens, ids_crc32``. A file of another size fails."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in rows for r in batch.to_pylist()):
            sequences = SequenceFile(row["path"])
            if sequences.real() != row["n_tokens"]:
                raise ValueError(f"{row['path']} holds {sequences.real()} ids instead of {row['n_tokens']}")
            files, inside = pafs.FileSystem.from_uri(row["docs_path"])
            with files.open_input_file(inside) as source:
                documents = pa.ipc.open_file(source)
                for i in range(documents.num_record_batches):
                    found = documents.get_batch(i)
                    places = zip(found.column("start").to_pylist(), found.column("n_tokens").to_pylist())
                    sums = [zlib.crc32(sequences.ids(s, n).astype("<u4").tobytes()) for s, n in places]
                    starts = pa.array(found.column("start").to_numpy() + row["first"])
                    yield pa.record_batch(
                        [found.column("doc_id"), starts, found.column("n_tokens"), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    files = max(1, manifest.count())
    return manifest.repartitionByRange(files, "part").mapInArrow(read, READ)
