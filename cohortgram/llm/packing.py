"""Best-fit-decreasing packing of documents into token windows.

A document is its ids and an end id. Documents longer than a window are first cut into full windows; what is
left of each goes, longest first, into the open window with the least room that still holds it, found in a
segment tree indexed by remaining capacity, or else opens a new one. No piece is cut again.

Tokens never move: the tokenizing pass puts out one short row per piece (place, length, checksum), stored in
the shared folder. Pieces are dealt into shards of about ``SHARD`` by a hash of the row and its place in its
task, so that copies spread too, and each shard is packed in one task. A shard leaves about one
window unfilled in hundreds, whatever the input.

Null text counts as empty: its one piece is the end id. Repeated rows are packed as often as they occur; a null
``doc_id`` is kept as null. No rows give no sequences. Columns besides ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm import memory
from cohortgram.llm.text import parts
from cohortgram.llm.tokens import pieces
from cohortgram.plans.storage import Scratch

WINDOW = 4096
#: Pieces packed together; a size, not a cap: there are as many shards as the pieces need.
SHARD = 8192

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Windows:
    """Open windows by remaining room: a segment tree over rooms whose nodes count the open windows below."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.by_room: list[list[int]] = [[] for _ in range(size + 1)]
        self.made = 0
        self.size = size

    def _count(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.open[node] += change
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that an open window has."""
        node = self.leaves + length
        if self.open[node]:
            return length
        while node > 1 and (node & 1 or not self.open[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves

    def put(self, length: int) -> tuple[int, int]:
        """Window and offset for a piece."""
        room = self.tightest(length)
        if room is None:
            window, room = self.made, self.size
            self.made += 1
        else:
            window = self.by_room[room].pop()
            self._count(room, -1)
        left = room - length
        if left:
            self.by_room[left].append(window)
            self._count(left, 1)
        return window, self.size - room


def pack_lengths(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each length, best fit decreasing. Lengths are at most ``size``."""
    windows, sequence, offset = Windows(size), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        sequence[i], offset[i] = windows.put(int(lengths[i]))
    return sequence, offset


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int = WINDOW) -> DataFrame:
    """A row per piece: full windows of each document, then its rest."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("packing")
        place = TaskContext.get().partitionId() << 40
        for batch in parts(rows):
            out = []
            texts = pieces(tokenizer).encode([t or "" for t in batch.column("text").to_pylist()])
            for doc, encoded in zip(batch.column("doc_id").to_pylist(), texts):
                encoded += end
                total = len(encoded) // 4
                for start in range(0, total, size):
                    length = min(size, total - start)
                    checksum = zlib.crc32(encoded[4 * start : 4 * (start + length)])
                    out.append((doc, start, length, checksum, total, place))
                    place += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            yield pa.record_batch(columns, names=[c.split()[0] for c in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def pack_documents(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int, size: int = WINDOW) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    found = scratch.keep("pieces", cut_pieces(docs, tokenizer, end_id, size))
    shards = -(-max(1, found.count()) // SHARD)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "place"], ascending=[False, True], kind="stable")
        sequence, offset = pack_lengths(group["length"].to_numpy(), size)
        return group.drop(columns=["place", "shard"]).assign(
            sequence_id=group["shard"].to_numpy() * (1 << 32) + sequence, offset=offset
        )

    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "place"), F.lit(shards))
    return found.withColumn("shard", shard).groupBy("shard").applyInPandas(pack, PACKED)
