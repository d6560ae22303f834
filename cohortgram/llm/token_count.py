"""Token counts by byte-pair merging with a heap and a linked list.

A piece of text starts as one symbol per byte. The adjacent pair of lowest rank is merged again and again, the
leftmost of equals first: a heap holds the mergeable pairs, a doubly linked list the symbols. Every merge makes
one symbol out of two, so the count is the bytes less the merges; no ids are put out. Counts of pieces seen are
kept per worker. Texts are split by the tokenizer's pattern; special strings inside a text count one token each.

A null or empty text has 0 tokens and 0 bytes. Rows are returned one for one, repeated rows included.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm import memory
from cohortgram.llm.text import parts
from cohortgram.llm.tokens import BYTE_PATTERN, MEMO_PIECES, UNUSUAL, byte_characters

COUNTED = "doc_id long, n_bytes long, n_tokens long"


class Counter:
    """Counts tokens of texts under the ranks of a byte-level tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        vocabulary = declared["model"]["vocab"]
        self._merges = {
            (vocabulary[left], vocabulary[right]): (rank, vocabulary[left + right])
            for rank, (left, right) in enumerate(declared["model"]["merges"])
        }
        self._symbols = [vocabulary[c] for c in byte_characters()]
        special = [re.escape(t["content"]) for t in declared["added_tokens"]]
        self._special = re.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self._find = re.compile(BYTE_PATTERN).findall
        self._split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._memo: dict[str, int] = {}

    def count(self, text: str) -> int:
        """Tokens of one text."""
        if self._special is None or "<" not in text:
            return self._plain(text)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        if UNUSUAL.search(text):
            pieces = [text[a:b] for _, (a, b) in self._split(text)]
        else:
            pieces = self._find(text)
        memo = self._memo
        total = 0
        for piece in pieces:
            known = memo.get(piece)
            if known is None:
                if len(memo) >= MEMO_PIECES:
                    memo.clear()
                known = memo[piece] = self.merged(piece.encode())
            total += known
        return total

    def merged(self, piece: bytes) -> int:
        """Symbols left when no adjacent pair of a piece can be merged."""
        merges, symbols = self._merges, [self._symbols[b] for b in piece]
        count = len(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = []
        for i in range(count - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, i + 1, found[1]))
        heapq.heapify(heap)
        left_over = count
        while heap:
            rank, i, j, merged = heapq.heappop(heap)
            if symbols[i] is None or after[i] != j:
                continue
            found = merges.get((symbols[i], symbols[j]))
            if not found or found[0] != rank:
                continue
            symbols[i], symbols[j] = merged, None
            k = after[i] = after[j]
            left_over -= 1
            if k < count:
                before[k] = i
                found = merges.get((merged, symbols[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, k, found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], merged))
                if found:
                    heapq.heappush(heap, (found[0], h, i, found[1]))
        return left_over


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker and file."""
    return Counter(path)


memory.kept(counter.cache_clear)


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row's whole text. One pass, no shuffle."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("token_count")
        for batch in parts(rows):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            counts = pa.array(map(counter(tokenizer).count, texts), pa.int64())
            yield pa.record_batch([batch.column("doc_id"), sizes, counts], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, COUNTED)
