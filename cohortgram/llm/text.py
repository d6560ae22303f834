"""Words and their hashes, as numpy arrays, for code that runs inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from cohortgram.llm import memory

#: Words whose hash a Python worker remembers before it starts over.
MEMO_WORDS = 200_000

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
_LOWER_ALNUM = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
#: Odd multipliers, one per position in a shingle.
_ODD = np.random.default_rng(20).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def spaced_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, with A-Z lower-cased."""
    return text.translate(_LOWER).split()


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text, with A-Z lower-cased."""
    return text.translate(_LOWER_ALNUM).split()


class WordHashes(dict):
    """64-bit hashes by word, of bounded size; one for all operators."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORDS = WordHashes()
memory.kept(WORDS.clear)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all of them."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words; of a shorter, non-empty sequence one hash of the whole."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    width = min(n, size)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out += words[i : n - width + 1 + i] * _ODD[i]
    return mixed(out)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null as empty."""
    binary = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    return [t or b"" for t in binary.to_pylist()]


def parts(rows: Iterable[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches cut up into at most ``size`` rows, so that what Python makes of one stays small; none is empty."""
    for batch in rows:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)
    memory.release()


def sliced(rows: Iterable[pa.RecordBatch], most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut up so that the text of each holds at most ``most`` bytes, or is one row; none is empty."""
    for batch in rows:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            full = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, full + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, longer by as many underscores as it takes to be none of the columns in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
