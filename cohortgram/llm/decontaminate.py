"""Benchmark decontamination with SimHash windows and multi-index Hamming search.

For every benchmark item a window as long as the item, counted in words, slides over the text. A window's
fingerprint is the SimHash of its word shingles, each weighed by how often it stands there. Items are found by
fingerprint: it is cut into ``PARTS`` blocks, and of two fingerprints at most ``RADIUS`` bits apart one block
differs in at most RADIUS // PARTS bits, so an index that holds each item's blocks with all such changes
finds every item within the radius. Those are then verified on the shingles themselves:
sum of minima / sum of maxima of the counts, ``THRESHOLD`` or more. Two lists of similarity 0.8 have a cosine of
0.89, differ in 10 of 64 bits on average, and in more than RADIUS with a probability near 0.0001.

Windows that share no shingle with any item of their length have similarity 0 with all of them; no fingerprint is made
for these.

The benchmark is stored in the shared folder and read there by the tasks, in chunks of at most ``CHUNK_ITEMS`` items and ``CHUNK_WORDS``
words (one item if it is longer); it never goes through the driver. The documents are read once and not shuffled. A task holds the index of
one chunk. Where there are more chunks, it holds ``GATHER`` bytes of text as well and looks these up in one chunk after the other.

Words are runs of letters and digits, lower-cased. An item or text with fewer words than a shingle has one shingle, its whole sequence; without words it
matches nothing. Null texts and items are empty. A text shorter than an item is its one window of it. Repeated items are each reported, repeated rows too.
Rows with null ids are reported with null ids.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from cohortgram.llm import memory
from cohortgram.llm.text import WORDS, alnum_words, free_name, shingle_hashes
from cohortgram.plans.storage import Scratch

SHINGLE = 5
THRESHOLD = 0.8
BITS = 64
PARTS = 4
RADIUS = 22
#: Items and words of the benchmark in a task's memory. The index takes up to 120 KB an item, whatever its length, so 60 MB a chunk, and
#: some 300 bytes a word, 30 MB.
CHUNK_ITEMS = 500
CHUNK_WORDS = 100_000
#: Bytes of text that are looked up in a chunk before the next is read.
GATHER = 32 << 20

_PART = BITS // PARTS
_TABLE = 20
#: From so many items of one length on, their block values have a table of 65,536 offsets; fewer are found by bisection.
_DIRECT = 16
HITS = ArrayType(
    StructType().add("item_id", "long").add("start", "long").add("n_words", "long").add("similarity", "double")
)
_HIT = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())])
)


def words_of(text: str | None) -> np.ndarray:
    return WORDS.of(alnum_words((text or "").lower().encode()))


def simhash(shingles: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Fingerprints of the runs of ``count`` shingles at ``starts``."""
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    return fingerprints(sums, starts, count)


def fingerprints(sums: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    positive = sums[starts + count] - sums[starts] > 0
    return np.packbits(positive, axis=1).view(">u8").ravel().astype(np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of minima over sum of maxima of the counts of two shingle lists."""
    values, side = np.unique(np.concatenate([a, b]), return_inverse=True)
    left = np.bincount(side[: len(a)], minlength=len(values))
    right = np.bincount(side[len(a) :], minlength=len(values))
    return float(np.minimum(left, right).sum() / np.maximum(left, right).sum())


def _changes() -> np.ndarray:
    """All masks of a block with at most RADIUS // PARTS bits."""
    masks = [0]
    for n in range(1, RADIUS // PARTS + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(_PART), n)]
    return np.array(masks, np.uint16)


def _blocks(prints: np.ndarray, part: int) -> np.ndarray:
    return ((prints >> np.uint64(part * _PART)) & np.uint64((1 << _PART) - 1)).astype(np.uint16)


class _SizeIndex:
    """The items of one length: fingerprints, and per block the items by block value."""

    def __init__(self, prints: np.ndarray, masks: np.ndarray):
        self.prints = prints
        self.tables = []
        numbers = np.arange(len(prints), dtype=np.uint16 if len(prints) <= 1 << 16 else np.int32)
        for part in range(PARTS):
            values = (_blocks(prints, part)[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            items = np.repeat(numbers, len(masks))[order]
            if len(prints) < _DIRECT:
                self.tables.append((values[order], items))
            else:
                counts = np.bincount(values, minlength=1 << _PART)
                self.tables.append((np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), items))

    def _ranges(self, table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the items of each block value begin and end."""
        if len(self.prints) < _DIRECT:
            return np.searchsorted(table, values, "left"), np.searchsorted(table, values, "right")
        at = values.astype(np.int64)
        return table[at].astype(np.int64), table[at + 1].astype(np.int64)

    def near(self, prints: np.ndarray) -> np.ndarray:
        """Pairs (print, item) at most RADIUS bits apart, as rows."""
        found = []
        for part, (table, items) in enumerate(self.tables):
            begin, end = self._ranges(table, _blocks(prints, part))
            counts = end - begin
            which = np.repeat(np.arange(len(prints)), counts)
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            found.append(which * len(self.prints) + items[np.repeat(begin, counts) + inside].astype(np.int64))
        pairs = np.unique(np.concatenate(found))
        which, item = np.divmod(pairs, len(self.prints))
        apart = np.bitwise_count(prints[which] ^ self.prints[item])
        close = apart <= RADIUS
        return np.stack([which[close], item[close]], axis=1)


class Benchmark:
    """The items of a chunk, ready for lookups."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        masks = _changes()
        by_size: dict[int, list] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if len(words):
                by_size[len(words)].append((item_id, shingle_hashes(words, SHINGLE)))
        self.items = dict(sorted(by_size.items()))
        self.indexes = {
            n: _SizeIndex(np.concatenate([simhash(s, np.zeros(1, np.int64), len(s)) for _, s in members]), masks)
            for n, members in self.items.items()
        }
        # Every shingle with the lengths of the items that have it.
        pairs = {(int(s), n) for n, members in self.items.items() for _, own in members for s in own}
        listed = sorted(pairs)
        self.known = np.array([s for s, _ in listed], np.uint64)
        self.size_of = np.array([n for _, n in listed], np.int64)
        self.maybe = np.zeros(1 << _TABLE, bool)
        self.maybe[self.known >> np.uint64(64 - _TABLE)] = True
        self.short = [n for n in self.items if n < SHINGLE]

    def hits(self, text: str | None) -> list[dict]:
        """The best window of every item that the text holds."""
        words = words_of(text)
        best: dict[tuple, dict] = {}
        shingles = shingle_hashes(words, SHINGLE)
        if len(words) >= SHINGLE:
            seen = np.flatnonzero(self.maybe[shingles >> np.uint64(64 - _TABLE)])
            first = np.searchsorted(self.known, shingles[seen], "left")
            counts = np.searchsorted(self.known, shingles[seen], "right") - first
            if counts.any():
                inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                self._search(shingles, np.repeat(seen, counts), self.size_of[np.repeat(first, counts) + inside], best)
        for n in self.short:
            # Shorter than a shingle: every window is one.
            own = mixed_windows(words, n)
            for at, (item_id, shingle) in enumerate(self.items[n]):
                places = np.flatnonzero(own == shingle[0])
                if len(places):
                    best[n, at] = {"item_id": item_id, "start": int(places[0]), "n_words": n, "similarity": 1.0}
        return list(best.values())

    def _search(self, shingles: np.ndarray, seen: np.ndarray, sizes: np.ndarray, best: dict) -> None:
        """Takes up the best windows; ``seen`` are places of known shingles, ``sizes`` the lengths to try there."""
        bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int8) * 2 - 1
        sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
        for n in np.unique(sizes).tolist():
            members, whole = self.items[n], n - SHINGLE + 1
            # A text shorter than the item is its one window; with too few shingles it cannot be similar enough.
            count = min(whole, len(shingles))
            if whole < 1 or count < THRESHOLD * whole:
                continue
            last = len(shingles) - count
            # Windows that hold a known shingle.
            here = seen[sizes == n]
            change = np.zeros(last + 2, np.int32)
            np.add.at(change, np.clip(here - count + 1, 0, last + 1), 1)
            np.add.at(change, np.minimum(here, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            for which, item in self.indexes[n].near(fingerprints(sums, starts, count)).tolist():
                start = int(starts[which])
                item_id, own = members[item]
                score = similarity(shingles[start : start + count], own)
                if score >= THRESHOLD and score > best.get((n, item), {"similarity": 0.0})["similarity"]:
                    best[n, item] = {"item_id": item_id, "start": start, "n_words": count + SHINGLE - 1, "similarity": score}


def mixed_windows(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` words, as of a whole sequence of that length."""
    return shingle_hashes(words, n) if len(words) >= n else np.empty(0, np.uint64)


def stored(benchmark: DataFrame) -> str:
    """The folder of the items, as Parquet that every task can read."""
    scratch = Scratch(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    scratch.keep("benchmark", items, rows=items.count())
    return scratch.folder("benchmark")


def chunks(folder: str, most_items: int, most_words: int) -> Iterator[list[tuple]]:
    """The stored items in lists of at most so many items and words, read piece by piece."""
    files, path = pafs.FileSystem.from_uri(folder)
    names = sorted(f.path for f in files.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet"))
    chunk, words = [], 0
    for name in names:
        with files.open_input_file(name) as source:
            for batch in pq.ParquetFile(source, buffer_size=1 << 20).iter_batches(64, columns=["item_id", "text"]):
                for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    size = len((text or "").split())
                    if chunk and (len(chunk) == most_items or words + size > most_words):
                        yield chunk
                        chunk, words = [], 0
                    chunk.append((item_id, text))
                    words += size
    if chunk:
        yield chunk


def gathered(texts: Iterator[pa.Array], most: int) -> Iterator[list[pa.Array]]:
    """The arrays in lists of about ``most`` bytes."""
    held, size = [], 0
    for array in texts:
        held.append(array)
        size += array.nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def with_hits(docs: DataFrame, folder: str, column: str) -> DataFrame:
    """The rows with ``column``: the stored items found in ``text``."""
    limits, most = (CHUNK_ITEMS, CHUNK_WORDS), GATHER

    @F.arrow_udf(HITS)
    def look(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory.begin("decontaminate")
        first = list(islice(chunks(folder, *limits), 2))
        if len(first) < 2:
            index = Benchmark(first[0] if first else [])
            for array in texts:
                yield pa.array([index.hits(t.as_py()) for t in array], _HIT)
        else:
            del first
            for arrays in gathered(texts, most):
                hits = [[[] for _ in array] for array in arrays]
                for items in chunks(folder, *limits):
                    index = Benchmark(items)
                    for array, found in zip(arrays, hits):
                        for text, own in zip(array, found):
                            own += index.hits(text.as_py())
                yield from (pa.array(found, _HIT) for found in hits)
        memory.release()

    # The texts go to Python and the hits come back; the other columns stay where they are.
    return docs.withColumn(column, look("text"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity``: the best window per row and benchmark item it holds, the first of equal ones."""
    found = with_hits(docs.select(F.col("doc_id").cast("long"), "text"), stored(benchmark), "hits")
    # For a plain explode Spark filters on the list first, and for that looks up the texts with hits twice.
    return found.select("doc_id", F.explode_outer("hits").alias("hit")).where("hit is not null").select("doc_id", "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any benchmark item, all columns as they are."""
    name = free_name(docs.columns, "_hits")
    return with_hits(docs, stored(benchmark), name).where(F.size(name) == 0).drop(name)
