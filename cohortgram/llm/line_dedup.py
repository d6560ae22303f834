"""Deletes the blocks of lines a document shares with an earlier one.

A text is cut after line breaks and sentence ends; the cuts are called lines here. Two lines are equal if their
words are. A block is a run of equal lines in both documents of ``MIN_WORDS`` words or more.

Candidates come from rare line hashes: for each line the hashes of the shortest runs of MIN_WORDS words that start
and that end there. One line may be common, such a run is not, unless its text is repeated. Every line of a block
lies in one that the block holds. Each hash pairs the documents that have it with the first of them alone, so pairs are never more than lines,
however many documents share a passage. No run is too frequent to count.

A pair is aligned by patience diff: runs of MIN_WORDS words that both documents have once, in their longest common order, are anchors;
equal lines beside anchors join them; the gaps between are aligned in turn, those without such an anchor from the first run that both
have. Aligned blocks are deleted from the later document with all their copies, and the documents are aligned again until the
alignment has met every run they share, which takes blocks that stand in another order.

Documents are ordered by ``doc_id``. A null or empty text has no lines. Rows with a null ``doc_id`` are left as
they are, and delete nothing. Rows with equal ids do not delete from each other. Other columns are kept; no rows
give no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm import memory
from cohortgram.llm.text import alnum_words, free_name, mixed, parts
from cohortgram.plans.storage import Scratch

#: Words a shared block must have.
MIN_WORDS = 20

_LINE = re.compile(r"[^.!?\n]*(?:[.!?]+\s*|\n\s*|\Z)")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_LINES = "doc_id long, version long, hashes binary, words binary"
_RUNS = "run long, doc_id long"
_CUT = "text string, n_lines long, n_deleted long"


def lines_of(text: str) -> list[str]:
    """The lines of a text; joined, they are the text."""
    return [line for line in _LINE.findall(text) if line]


def line_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of the words of each line."""
    words = [alnum_words(line.encode()) for line in lines]
    hashes = np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for w in words], np.uint64)
    return hashes, np.array([len(w) for w in words], np.uint32)


def shortest_runs(words: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the shortest runs of MIN_WORDS words from each line and up to each.

    ``sizes`` are the lines of the documents that ``words`` has one after the other; no run leaves its document.
    """
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.searchsorted(total, total[:-1] + MIN_WORDS, "left")
    starts = np.searchsorted(total, total[1:] - MIN_WORDS, "right") - 1
    begun = np.flatnonzero(ends <= np.repeat(bounds[1:], sizes))
    ended = np.flatnonzero(starts >= np.repeat(bounds[:-1], sizes))
    return np.concatenate([begun, starts[ended]]), np.concatenate([ends[begun], ended + 1])


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of lines, the same wherever it stands."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(n, _BASE, np.uint64))
        back = np.cumprod(np.full(n, _INVERSE, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)])
        return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


#: A run of lines: where it starts and ends, and its hash.
Run = tuple[int, int, int]


def _inside(runs: list[Run], first: int, last: int) -> list[Run]:
    """The runs, ordered by start, that lie within a region."""
    found = runs[bisect_left(runs, (first,)) : bisect_left(runs, (last,))]
    return [r for r in found if r[1] <= last]


def _anchors(a: list[Run], b: list[Run]) -> list[tuple[int, int]]:
    """Starts of runs that stand once on either side, in their longest common order.

    Where there is none, the first run that stands on both sides at all, at its first place on each.
    """
    times_a, times_b = Counter(h for _, _, h in a), Counter(h for _, _, h in b)
    in_b = {h: start for start, _, h in reversed(b)}
    both = [(start, in_b[h]) for start, _, h in a if times_a[h] == 1 and times_b[h] == 1]
    if not both:
        return next(([(start, in_b[h])] for start, _, h in a if h in in_b), [])
    tails: list[int] = []
    at: list[int] = []
    before: list[int | None] = []
    for k, (_, j) in enumerate(both):
        p = bisect_left(tails, j)
        before.append(at[p - 1] if p else None)
        if p == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[p], at[p] = j, k
    chain, k = [], at[-1] if at else None
    while k is not None:
        chain.append(both[k])
        k = before[k]
    return chain[::-1]


def patience(a: list[int], b: list[int], a_runs: list[Run], b_runs: list[Run]) -> list[tuple[int, int]]:
    """Blocks ``[from, to)`` of ``a`` that an alignment with ``b`` holds, ascending.

    Anchors are shared runs; each grows both ways over equal lines, and the regions between are aligned in turn.
    """
    blocks, open_regions = [], [(0, len(a), 0, len(b))]
    while open_regions:
        a_from, a_to, b_from, b_to = open_regions.pop()
        anchors = _anchors(_inside(a_runs, a_from, a_to), _inside(b_runs, b_from, b_to))
        if not anchors:
            continue
        x, y = a_from, b_from
        for i, j in anchors:
            if i < x or j < y:
                continue  # lies in the block before
            while i > x and j > y and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
            open_regions.append((x, i, y, j))
            start = i
            while i < a_to and j < b_to and a[i] == b[j]:
                i, j = i + 1, j + 1
            blocks.append((start, i))
            x, y = i, j
        open_regions.append((x, a_to, y, b_to))
    return sorted(blocks)


def shared_blocks(later: np.ndarray, words: np.ndarray, earlier: np.ndarray) -> list[tuple[int, int]]:
    """Runs ``[from, to)`` of the later document to delete.

    The documents are aligned, the aligned blocks go with all their copies, and what is left is aligned again until no run of the later
    document that the earlier one has anywhere is left in whole or in part.
    """
    mine, theirs = _runs_of_both(later, words, earlier)
    a, b = later.tolist(), earlier.tolist()
    gone = np.zeros(len(a), bool)
    open_ = mine
    while open_:
        found = patience(a, b, open_, theirs)
        if not found:
            break
        for x, y in found:
            gone[x:y] = True
        # Runs within an aligned block go wherever they stand.
        starts = [x for x, _ in found]
        aligned = {h for s, e, h in mine if (k := bisect_left(starts, s + 1)) and e <= found[k - 1][1]}
        for s, e, h in mine:
            if h in aligned:
                gone[s:e] = True
        open_ = [r for r in open_ if not gone[r[0] : r[1]].all()]
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _runs_of_both(later: np.ndarray, words: np.ndarray, earlier: np.ndarray) -> tuple[list[Run], list[Run]]:
    """The shortest runs that both documents have, of each of them, by start."""
    lines, first = np.unique(later, return_index=True)
    at = np.minimum(np.searchsorted(lines, earlier), len(lines) - 1) if len(lines) else np.zeros(len(earlier), np.int64)
    # Equal lines have equal words; a line the later document lacks is in no shared run, whatever its words.
    there = np.where(lines[at] == earlier, words[first[at]], np.uint32(0)) if len(lines) else np.zeros(len(earlier), np.uint32)
    starts, ends = shortest_runs(np.concatenate([words, there]), [len(later), len(earlier)])
    runs = run_hashes(np.concatenate([later, earlier]), starts, ends)
    own = starts < len(later)
    out = []
    for side, other, base in ((own, ~own, 0), (~own, own, len(later))):
        shared = np.flatnonzero(side)[np.isin(runs[side], runs[other])]
        out.append(sorted(set(zip((starts[shared] - base).tolist(), (ends[shared] - base).tolist(), runs[shared].tolist()))))
    return out[0], out[1]


def _hash_lines(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory.begin("line_dedup")
    for batch in parts(rows):
        hashed = [line_hashes(lines_of(t or "")) for t in batch.column("text").to_pylist()]
        columns = [pa.array([h[c].tobytes() for h in hashed], pa.binary()) for c in range(2)]
        ids = [batch.column(c) for c in ("doc_id", "version")]
        yield pa.record_batch([*ids, *columns], names=["doc_id", "version", "hashes", "words"])


def _runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(rows):
        hashes, words = (batch.column(c).to_pylist() for c in ("hashes", "words"))
        sizes = [len(h) // 8 for h in hashes]
        starts, ends = shortest_runs(np.frombuffer(b"".join(words), np.uint32), sizes)
        runs = run_hashes(np.frombuffer(b"".join(hashes), np.uint64), starts, ends)
        place = np.repeat(np.arange(batch.num_rows), sizes)[starts]
        order = np.lexsort((runs, place))
        runs, place = runs[order], place[order]
        # Each run once a document.
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:] != runs[:-1]) | (place[1:] != place[:-1])
        doc = batch.column("doc_id").take(pa.array(place[new]))
        yield pa.record_batch([pa.array(runs[new].view(np.int64)), doc], names=["run", "doc_id"])


def _align(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(rows):
        out = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "version", "hashes", "words", "earlier")]
        for doc_id, version, hashes, words, earlier in zip(*columns):
            later, other = np.frombuffer(hashes, np.uint64), np.frombuffer(earlier, np.uint64)
            for start, end in shared_blocks(later, np.frombuffer(words, np.uint32), other):
                out.append((doc_id, version, start, end))
        arrays = [pa.array([r[c] for r in out], pa.int64()) for c in range(4)]
        yield pa.record_batch(arrays, names=["doc_id", "version", "start", "end"])


def find_blocks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, version, blocks``: the runs of lines to delete; ``version`` is a hash of the text."""
    known = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("version"), "text")
    lines = scratch.keep("lines", known.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_hash_lines, _LINES))
    # Made twice from the stored lines rather than stored: they are as large as what they come from.
    runs = lines.mapInArrow(_runs, _RUNS)
    first = runs.groupBy("run").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = first.where("first < last").select("run", "first")
    pairs = runs.join(shared, "run").where("doc_id > first").select("doc_id", "first").distinct()
    earlier = lines.select(F.col("doc_id").alias("first"), F.col("hashes").alias("earlier"))
    both = pairs.join(lines, "doc_id").join(earlier, "first").select("doc_id", "version", "hashes", "words", "earlier")
    blocks = both.mapInArrow(_align, "doc_id long, version long, start long, end long")
    found = blocks.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "end")).alias("blocks"))
    return scratch.keep("blocks", found)


def without_shared_blocks(
    docs: DataFrame, scratch: Scratch, counts: tuple[str, str] = ("n_lines", "n_deleted")
) -> DataFrame:
    """The rows with the blocks deleted from ``text``, and the number of lines and of deleted ones as ``counts``.

    Columns of those names are replaced; all others are kept.
    """
    blocks = find_blocks(docs, scratch)
    doc, version, places, done = (free_name(docs.columns, n) for n in ("_doc", "_version", "_blocks", "_done"))
    marked = docs.withColumn(doc, F.col("doc_id").cast("long")).withColumn(version, F.xxhash64("text"))
    found = blocks.select(F.col("doc_id").alias(doc), F.col("version").alias(version), F.col("blocks").alias(places))
    # The same plan at every size: a few shared passages are no reason to send them to all tasks.
    joined = marked.join(found.hint("merge"), [doc, version], "left").drop(doc, version)

    @F.arrow_udf(_CUT)
    def cut(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        memory.begin("line_dedup")
        for texts, found in pairs:
            out: list[list] = [[], [], []]
            for text, own in zip(texts, found):
                text, own = text.as_py(), own.as_py()
                lines = lines_of(text or "")
                gone = {i for block in own or () for i in range(block["start"], block["end"])}
                out[0].append("".join(line for i, line in enumerate(lines) if i not in gone) if gone else text)
                out[1].append(len(lines))
                out[2].append(len(gone))
            arrays = [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())]
            yield pa.StructArray.from_arrays(arrays, names=["text", "n_lines", "n_deleted"])
        memory.release()

    # Text and blocks go to Python, once even where a caller filters by the counts; the other columns stay where they are.
    cut_rows = joined.withColumn(done, cut.asNondeterministic()("text", places))
    kept = [F.col(f"{done}.text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in counts]
    return cut_rows.select(*kept, F.col(f"{done}.n_lines").alias(counts[0]), F.col(f"{done}.n_deleted").alias(counts[1]))
