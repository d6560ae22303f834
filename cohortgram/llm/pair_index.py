"""An inverted index from pairs to documents, as compressed bitmaps.

Documents are numbered from 0 inside blocks. For every pair and block there is one posting: the bitmap of the documents that hold the
pair, and planes for how often: plane k has the documents whose number of further occurrences (beyond the first) has bit k
set. So a pair's documents are the popcount of its bitmap, and its occurrences that popcount plus, per plane, the
plane's popcount times 2 to the power k. Blocks have no documents in common: merging the bitmaps of a pair by OR
lays its containers end to end, and popcounts add up.

A container is a sorted list of 16-bit numbers while that is shorter than ``BITMAP`` bytes, and a bitmap of ``BITMAP`` bytes, one
bit a document, otherwise; its size tells which. Popcounts are taken inside Spark's own expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of a bitmap container; a block has at most eight documents a byte.
BITMAP = 8192
BLOCK_DOCS = BITMAP * 8

POSTING = pa.schema([("pair", pa.int64()), ("docs", pa.binary()), ("planes", pa.list_(pa.binary()))])


def _containers(docs: np.ndarray, begins: np.ndarray) -> pa.Array:
    """A container for each run of sorted document numbers; ``begins`` has where the runs begin, and the end."""
    sizes = np.diff(begins)
    values, offsets = docs.astype("<u2").tobytes(), 2 * begins
    dense = np.flatnonzero(2 * sizes >= BITMAP)
    if len(dense):
        pieces, at = [], 0
        lengths = 2 * sizes
        for i in dense.tolist():
            bits = np.zeros(BLOCK_DOCS, np.uint8)
            bits[docs[begins[i] : begins[i + 1]]] = 1
            pieces += [values[at : offsets[i]], np.packbits(bits, bitorder="little").tobytes()]
            at, lengths[i] = offsets[i + 1], BITMAP
        values = b"".join([*pieces, values[at:]])
        offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])


def postings(pairs: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """The postings of one block, from its entries ``(pair, document, occurrences)``, each pair and document once."""
    order = np.lexsort((docs, pairs))
    pairs, docs, more = pairs[order], docs[order], counts[order] - 1
    begins = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.empty(0, np.int64)
    owner = np.zeros(len(pairs), np.int64)
    owner[begins[1:]] = 1
    owner = np.cumsum(owner)
    # Entries of each plane, in order of pair, plane and document.
    top = int(more.max()).bit_length() if len(more) else 0
    chosen = [np.flatnonzero(more >> k & 1) for k in range(top)]
    at = np.concatenate([*chosen, np.empty(0, np.int64)]).astype(np.int64)
    plane = np.repeat(np.arange(top), [len(c) for c in chosen])
    sorted_ = np.lexsort((at, plane, owner[at]))
    at, plane = at[sorted_], plane[sorted_]
    # A pair has all planes up to its highest, empty ones too.
    heights = np.zeros(len(begins), np.int64)
    np.maximum.at(heights, owner[at], plane + 1)
    firsts = np.concatenate([[0], np.cumsum(heights)])
    sizes = np.bincount(firsts[owner[at]] + plane, minlength=int(firsts[-1]))
    planes = _containers(docs[at], np.concatenate([[0], np.cumsum(sizes)]))
    lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), planes)
    return pa.record_batch(
        [pa.array(pairs[begins].astype(np.int64)), _containers(docs, np.append(begins, len(docs))), lists], schema=POSTING
    )


def members(containers: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(container, document)`` of every document in an array of containers."""
    if isinstance(containers, pa.ChunkedArray):
        containers = containers.combine_chunks()
    offsets = np.frombuffer(containers.buffers()[1], np.int32)[containers.offset : containers.offset + len(containers) + 1]
    offsets = offsets.astype(np.int64) if len(containers) else np.zeros(1, np.int64)
    sizes = np.diff(offsets)
    values = containers.buffers()[2]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    dense = sizes == BITMAP
    if not dense.any():
        return np.repeat(np.arange(len(sizes)), sizes // 2), raw.view("<u2").astype(np.int64)
    listed = raw[np.repeat(~dense, sizes)].view("<u2").astype(np.int64)
    which, docs = [np.repeat(np.flatnonzero(~dense), sizes[~dense] // 2)], [listed]
    for i in np.flatnonzero(dense).tolist():
        found = np.flatnonzero(np.unpackbits(raw[offsets[i] : offsets[i + 1]], bitorder="little"))
        which.append(np.full(len(found), i))
        docs.append(found)
    return np.concatenate(which), np.concatenate(docs)


def popcount(container: Column) -> Column:
    """Documents in a container."""
    size = F.octet_length(container)
    return F.when(size == BITMAP, F.bitmap_count(container)).otherwise((size / 2).cast("long"))


def occurrences(docs: Column, planes: Column) -> Column:
    """Occurrences in a posting."""
    further = F.transform(planes, lambda p, k: popcount(p) * F.pow(F.lit(2.0), k).cast("long"))
    return F.aggregate(further, popcount(docs), lambda total, n: total + n)


def add_scores(block: pa.Table, weights: list[str], size: int) -> list[np.ndarray]:
    """Per document of a block, and per column of ``weights``, the sum over its occurrences of their pair's weight."""
    which, docs = members(block["docs"])
    lists = block["planes"].combine_chunks()
    starts = np.asarray(lists.offsets, np.int64)
    lengths = np.diff(starts)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    power = np.arange(len(owner)) - np.repeat(starts[:-1] - starts[0], lengths)
    plane, more = members(lists.flatten())
    out = []
    for name in weights:
        weight = block[name].to_numpy().astype(np.int64)
        total = np.zeros(size, np.int64)
        np.add.at(total, docs, weight[which])
        np.add.at(total, more, weight[owner[plane]] << power[plane])
        out.append(total)
    return out
