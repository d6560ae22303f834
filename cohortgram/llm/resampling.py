"""Importance resampling of documents towards a target distribution.

A document's features are its runs of 1 to 3 words, each hashed to one of ``BUCKETS`` buckets by the CRC-32 of its bytes. The gain of a bucket
is how much more frequent it is in the target than in the documents, in thousandths of a natural logarithm, and the weight of a document is
the sum of the gains of its features. A Gumbel number from a hash of the id is added, and the documents of the highest sums are drawn: a
sample without replacement in proportion to the weights.

Two passes over the texts: the first counts buckets, one array of ``BUCKETS`` numbers a task; the second scores every
document with the array of gains. The rows that may be drawn are then put in order by a distributed radix sort (``radix_sort``) on the id,
then on the falling score, and get their places as ranks. Texts are never shuffled. The CRC of a run of words is made
of those of its words: appending n bytes to a checked text is a linear map of its CRC, tabulated per n (``_append_tables``).

A null text has no features and weight 0. A null ``doc_id`` has a null score and is never drawn. Repeated rows are scored and drawn one by one;
of rows with the same id and score any may come first. Without target texts all counts of the target are 0. No rows give no rows. Columns besides
``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm import memory
from cohortgram.llm.radix_sort import places, unsigned
from cohortgram.llm.text import alnum_words, sliced, texts_of
from cohortgram.plans.storage import Scratch

BUCKETS = 10_000
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20
#: Percent of the documents that may be drawn.
SHARE = 5
SEED = 42

#: Bytes of text in work at once.
SLICE = 2 << 20
#: Words longer than this are checked with the words before them byte by byte.
_LONGEST = 64
_MEMO = 200_000

SCORED = "doc_id long, n_features long, weight long, score long, n_words long"
_NAMES = [c.split()[0] for c in SCORED.split(", ")]


@lru_cache(maxsize=1)
def _append_tables() -> np.ndarray:
    """``[n, i, b]``: what byte ``i`` of a CRC, of value ``b``, comes to after ``n`` more zero bytes, for n up to _LONGEST + 1."""
    out = np.empty((_LONGEST + 2, 4, 256), np.uint32)
    for i in range(4):
        out[0, i] = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
    # The CRC after one more byte 0, of every CRC: zlib's own step, with its inversions taken out.
    one = np.array([zlib.crc32(b"\0", b ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    for n in range(1, _LONGEST + 2):
        before = out[n - 1]
        out[n] = (before >> np.uint32(8)) ^ one[before & np.uint32(255)]
    return out


def appended(first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRCs of texts laid end to end, from those of both and the size of the second."""
    tables = _append_tables()
    out = second.copy()
    for i in range(4):
        out ^= tables[sizes, i, (first >> np.uint32(8 * i)) & np.uint32(255)]
    return out


class _Words(dict):
    """CRC of a word and its size, packed into one number; of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        size = min(len(word), _LONGEST + 1)
        value = self[word] = zlib.crc32(word) | size << 32
        return value


_WORDS = _Words()
memory.kept(_WORDS.clear)
_SPACE = zlib.crc32(b" ")


def buckets_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features of all texts, features per text, and words per text. The order of features is not kept."""
    listed = [alnum_words(t) for t in texts]
    counts = np.array([len(w) for w in listed], np.int64)
    words = [w for own in listed for w in own]
    packed = np.fromiter(map(_WORDS.__getitem__, words), np.int64, len(words))
    alone, sizes = (packed & 0xFFFFFFFF).astype(np.uint32), packed >> 32
    owner = np.repeat(np.arange(len(texts)), counts)
    spaced = appended(np.full(len(words), _SPACE, np.uint32), alone, np.minimum(sizes, _LONGEST))
    found, owners, run = [alone], [owner], alone
    long = np.flatnonzero(sizes > _LONGEST).tolist()
    for width in (2, 3):
        last = np.arange(width - 1, len(words))
        whole = owner[last] == owner[last - width + 1] if len(last) else np.zeros(0, bool)
        run = appended(run[: len(last)], spaced[last], np.minimum(sizes[last], _LONGEST) + 1)
        for at in long:
            for i in range(max(at - width + 1, 0), min(at, len(last) - 1) + 1):
                run[i] = zlib.crc32(b" ".join(words[i : i + width]))
        found.append(run[whole])
        owners.append(owner[last][whole])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    features = np.bincount(owners, minlength=len(texts))
    return np.concatenate(found)[order] % np.uint32(BUCKETS), features, counts


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: ``BUCKETS`` numbers, summed in the tasks, then by Spark."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in sliced(rows, SLICE):
            total += np.bincount(buckets_of(texts_of(batch.column("text")))[0], minlength=BUCKETS)
        full = np.flatnonzero(total)
        yield pa.record_batch([pa.array(full), pa.array(total[full])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS))))."""
    total, wanted = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * total / ((s + 1.0) * wanted))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def gumbel(doc_id: int, seed: int = SEED) -> int:
    """floor(-1000 ln(-ln u)) for the u that the id hashes to."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """Every row's features, weight, score and words."""

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(rows, SLICE):
            buckets, features, words = buckets_of(texts_of(batch.column("text")))
            sums = np.concatenate([[0], np.cumsum(gain[buckets])])
            ends = np.cumsum(features)
            weights = sums[ends] - sums[ends - features]
            ids = batch.column("doc_id").to_pylist()
            scores = [None if i is None else w + gumbel(i, seed) for i, w in zip(ids, weights.tolist())]
            columns = [batch.column("doc_id"), pa.array(features), pa.array(weights), pa.array(scores, pa.int64()), pa.array(words)]
            yield pa.record_batch(columns, names=_NAMES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, SCORED)


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null for those not drawn."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = scratch.keep("scored", scored(docs, gain, seed))
    long_enough = F.col("n_words") >= LEAST_WORDS
    possible = long_enough & F.col("score").isNotNull()
    facts = rows.agg(F.count_if(long_enough).alias("n"), F.max(F.when(possible, F.col("score"))).alias("most")).first()
    # Falling scores as distances from the highest: few digits, and no sign.
    fallen = F.lit(facts["most"]).cast("long") - F.col("score")
    entered = rows.where(possible).withColumns({"low": unsigned(F.col("doc_id")), "high": fallen})
    placed = places(entered, ["low", "high"], scratch, "places")
    drawn = SHARE * facts["n"] // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = rows.where(~possible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.select(*columns, rank).unionByName(rest)
