"""Two tokenizers aligned by bytes, with corpus-wide counts of linked ids.

A text's tokens by both tokenizers cover the same bytes, a space and the text. Two tokens are linked where their byte ranges
overlap; bytes at which tokens of both end cut the text into groups. How often two ids are linked in the corpus, and in how
many documents, comes from an inverted index of id pairs (``pair_index``): each task turns its documents into blocks of
postings, compressed bitmaps with multiplicity planes, whose popcounts Spark sums up per pair. The postings of a block then take the
counts of their pairs back to its documents.

Bitmaps are shuffled once, to the documents of their block. Popcounts (partly summed in the tasks) and, for the join with the counts, the pairs and blocks
of postings go without them, two numbers a posting, at any size: the join is never a broadcast, and what is shuffled grows with the input.
A block ends at ``ENTRIES`` pairs of an id pair and a document, or ``BLOCK_DOCS`` documents, so its group is of bounded size; a frequent pair has
one posting a block, and a join with many of them is split by Spark. Texts are read once and never shuffled.

A text that is null or empty, or whose token bytes differ from the space and the text, has no tokens: all numbers are 0 and the digest is
empty. Rows are returned one for one: repeated rows and rows with a null id each count as a document. No rows give no rows. Columns
besides ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm import memory, pair_index
from cohortgram.llm.text import sliced
from cohortgram.llm.tokens import byte_characters, pieces
from cohortgram.plans.storage import Scratch

#: Bytes of text aligned at once.
SLICE = 1 << 20
#: Entries of a block: pairs of an id pair and a document that holds it.
ENTRIES = 1_000_000
#: Words whose ids by the second tokenizer a worker remembers: some 250 bytes each.
MEMO_WORDS = 250_000
#: Bits of a pair that hold the second id.
_SECOND = 20

_DOCUMENT = (
    "block long, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, docs binary, planes array<binary>"
)
_NAMES = [c.split()[0] for c in _DOCUMENT.split(", ")]
_DOC_COLUMNS = _NAMES[:8]
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
_SPACE_MARK = "▁"


class _Words:
    """Ids of texts by a sentencepiece model whose pieces hold its mark for a space at their start alone.

    Then no piece crosses the border between a word and the space behind it, so that words can be encoded, and remembered, one by one. Texts
    with spaces side by side or at their ends, or a model of another kind, go to the library whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(_SPACE_MARK, " ").encode() for i, n in enumerate(names)
        ]
        self._apart = not any(re.search(f"[^{_SPACE_MARK}]{_SPACE_MARK}", n) for n in names)
        self._memo: dict[str, bytes] = {}

    def library(self, text: str) -> bytes:
        return np.array(self.model.encode(text, num_threads=1), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") if self._apart else [""] for t in texts]
        single = ["" not in words for words in split]
        new = set().union(*(w for w, one in zip(split, single) if one)) - self._memo.keys()
        if len(self._memo) + len(new) > MEMO_WORDS:
            self._memo.clear()
            new = set().union(*(w for w, one in zip(split, single) if one))
        listed = list(new)
        for word, ids in zip(listed, self.model.encode(listed, num_threads=1) if listed else ()):
            self._memo[word] = np.array(ids, "<u4").tobytes()
        get = self._memo.__getitem__
        return [b"".join(map(get, words)) if one else self.library(t) for t, words, one in zip(texts, split, single)]


class Aligner:
    """Encodes texts by both tokenizers and aligns them."""

    def __init__(self, first: str, second: str):
        self.first, self.second = pieces(first, True), _Words(second)
        with open(first, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte_of = {ord(c): b for b, c in enumerate(byte_characters())}
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            # Special tokens are no byte strings, and no ids of ordinary text.
            self.first_bytes[number] = bytes(byte_of[ord(c)] for c in name) if all(ord(c) in byte_of for c in name) else b""
        self.first_sizes = np.array(list(map(len, self.first_bytes)), np.int64)
        self.second_sizes = np.array(list(map(len, self.second.bytes)), np.int64)
        self.shift = 2 * len(self.first_bytes)
        self.written = [b"%d%s" % (i, end) for i in range(len(self.first_bytes)) for end in (b",", b"|")]
        self.written += [b"%d%s" % (i, end) for i in range(len(self.second.bytes)) for end in (b",", b";")]

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text by both, none where the bytes of the tokens are not those of a space and the text."""
        spaced = [" " + t for t in texts]
        first, second = self.first.encode(spaced), self.second.encode(texts)
        nothing = np.empty(0, np.uint32)
        out: tuple[list, list] = ([], [])
        for text, whole, a, b in zip(texts, spaced, first, second):
            a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
            wanted = whole.encode()
            same = text and all(
                b"".join(map(table.__getitem__, ids.tolist())) == wanted
                for table, ids in ((self.first_bytes, a), (self.second.bytes, b))
            )
            out[0].append(a if same else nothing)
            out[1].append(b if same else nothing)
        return out

    def align(self, texts: list[str]) -> dict:
        """Numbers and digest per text, and its links as ``(pair, text)``."""
        first, second = self.tokens(texts)
        n_a, n_b = (np.array(list(map(len, ids)), np.int64) for ids in (first, second))
        a, b = (np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int64) for ids in (first, second))
        ends_a, ends_b = np.cumsum(self.first_sizes[a]), np.cumsum(self.second_sizes[b])
        total = int(ends_a[-1]) if len(a) else 0
        mark = np.zeros(total + 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        cuts = np.flatnonzero(mark)
        kind = mark[cuts]
        of_a, of_b, both = (kind & 1).astype(bool), (kind & 2).astype(bool), kind == 3
        # Between two cuts lies the overlap of one token of each.
        in_a, in_b, in_group = (np.cumsum(m) - m for m in (of_a, of_b, both))
        owner = np.repeat(np.arange(len(texts)), n_a)
        of_link = owner[in_a]
        group_a, group_b = in_group[of_a], in_group[of_b]
        groups = int(both.sum())
        held_a, held_b = (np.bincount(g, minlength=groups) for g in (group_a, group_b))
        # Tokens in the order they are written: those of the first tokenizer, then of the second, group by group.
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + (np.cumsum(held_b) - held_b)[group_a]] = 2 * a + both[of_a]
        code[np.arange(len(b)) + np.cumsum(held_a)[group_b]] = self.shift + 2 * b + both[of_b]
        get, digests, at = self.written.__getitem__, [], 0
        for size in (n_a + n_b).tolist():
            written = b"".join(map(get, code[at : at + size].tolist()))[:-1]
            digests.append(hashlib.sha256(written).hexdigest() if size else "")
            at += size
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(of_link[both], minlength=len(texts)),
            "n_links": np.bincount(of_link, minlength=len(texts)),
            "digests": digests,
            "pairs": a[in_a] << _SECOND | b[in_b],
            "texts": of_link,
        }


@lru_cache(maxsize=1)
def aligner(first: str, second: str) -> Aligner:
    """One per worker and pair of files."""
    return Aligner(first, second)


memory.kept(aligner.cache_clear)


class _Block:
    """The documents and entries of a block that is being filled."""

    def __init__(self, number: int):
        self.number, self.docs, self.entries = number, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, found: dict, ids: pa.Array) -> pa.RecordBatch:
        """Takes up aligned texts and returns their rows."""
        count = len(ids)
        # Occurrences of each pair in each text.
        keys, occurrences = np.unique(found["texts"] << 40 | found["pairs"], return_counts=True)
        self.parts.append((keys & ((1 << 40) - 1), (keys >> 40) + self.docs, occurrences))
        self.entries += len(keys)
        numbers = [np.full(count, self.number), self.docs + np.arange(count)]
        columns = [pa.array(n) for n in numbers] + [ids]
        columns += [pa.array(found[n].astype(np.int64)) for n in ("n_a", "n_b", "n_groups", "n_links")]
        columns.append(pa.array(found["digests"], pa.string()))
        columns += [pa.nulls(count, f.type) for f in pair_index.POSTING]
        self.docs += count
        return pa.record_batch(columns, names=_NAMES)

    def postings(self) -> Iterator[pa.RecordBatch]:
        pairs, docs, counts = (np.concatenate(c) for c in zip(*self.parts))
        self.parts = []
        rows = pair_index.postings(pairs, docs, counts)
        for start in range(0, rows.num_rows, 50_000):
            some = rows.slice(start, 50_000)
            columns = [pa.array(np.full(some.num_rows, self.number))]
            columns += [pa.nulls(some.num_rows, pa.string() if n == "groups_sha256" else pa.int64()) for n in _DOC_COLUMNS[1:]]
            yield pa.record_batch(columns + some.columns, names=_NAMES)


def indexed(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Two kinds of rows from one pass: aligned documents (``pair`` is null), and the postings of their blocks."""

    def index(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("token_alignment")
        next_block = TaskContext.get().partitionId() << 32
        block = None
        for batch in sliced(rows, SLICE):
            for start in range(0, batch.num_rows, pair_index.BLOCK_DOCS // 8):
                some = batch.slice(start, pair_index.BLOCK_DOCS // 8)
                found = aligner(first, second).align([t or "" for t in some.column("text").to_pylist()])
                if block is not None and (block.docs + some.num_rows > pair_index.BLOCK_DOCS or block.entries >= ENTRIES):
                    yield from block.postings()
                    block = None
                if block is None:
                    block, next_block = _Block(next_block), next_block + 1
                yield block.add(found, some.column("doc_id"))
        if block is not None:
            yield from block.postings()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(index, _DOCUMENT)


def pair_counts(postings: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links``: documents that hold a pair of ids, and its links in all of them."""
    n_links = pair_index.occurrences(F.col("docs"), F.col("planes"))
    return postings.select("pair", pair_index.popcount(F.col("docs")).alias("docs"), n_links.alias("links")).groupBy("pair").agg(
        F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links")
    )


def weighed(parts: pa.Table) -> pa.Table:
    """The postings of a block with the weights of their pairs, from rows of either; each pair has one of both."""
    of_posting = pc.is_valid(parts["docs"])
    postings = parts.filter(of_posting).sort_by("pair").select(["docs", "planes"])
    weights = parts.filter(pc.invert(of_posting)).sort_by("pair").select(["n_links", "best"])
    for name in weights.column_names:
        postings = postings.append_column(name, weights[name])
    return postings


def align(docs: DataFrame, scratch: Scratch, first: str, second: str) -> DataFrame:
    """Every row's tokens, groups and links, the links whose pair is the commonest of their second id, and the sum of their counts."""
    rows = scratch.keep("aligned", indexed(docs, first, second))
    postings = rows.where("pair IS NOT NULL").select("block", "pair", "docs", "planes")
    counts = scratch.keep("pairs", pair_counts(postings)).withColumn("second", F.col("pair").bitwiseAND(F.lit((1 << _SECOND) - 1).cast("long")))
    highest = counts.groupBy("second").agg(F.max("n_links").alias("most"))
    weights = counts.join(highest, "second").select("pair", "n_links", (F.col("n_links") == F.col("most")).cast("long").alias("best"))
    held = postings.select("pair", F.col("block").alias("of_block")).hint("merge")
    # Either a posting of a block or the weights of its pair.
    parts = postings.select(F.col("block").alias("of_block"), "pair", "docs", "planes").unionByName(
        held.join(weights, "pair").select("of_block", "pair", "n_links", "best"), allowMissingColumns=True
    )

    def score(documents: pa.Table, block: pa.Table) -> pa.Table:
        place = documents["place"].to_numpy()
        size = int(place.max()) + 1 if len(place) else 0
        total, best = pair_index.add_scores(weighed(block), ["n_links", "best"], size) if block.num_rows else [np.zeros(size, np.int64)] * 2
        made = {"n_best": pa.array(best[place]), "count_sum": pa.array(total[place])}
        return pa.table({n: made[n] if n in made else documents[n] for n in (c.split()[0] for c in ALIGNED.split(", "))})

    documents = rows.where("pair IS NULL").select(*_DOC_COLUMNS)
    return documents.groupBy("block").cogroup(parts.groupBy("of_block")).applyInArrow(score, ALIGNED)
