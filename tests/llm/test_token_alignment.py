import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortgram.llm import pair_index, token_alignment
from cohortgram.llm.registry import BYTE_BPE, PIECE_BPE, tokenizer

FIRST, SECOND = tokenizer(BYTE_BPE), tokenizer(PIECE_BPE)


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    with open(FIRST, encoding="utf-8") as file:
        names = {i: n for n, i in json.load(file)["model"]["vocab"].items()}
    chars = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in chars} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in chars)}

    def of_second(i):
        name = second.id_to_piece(i)
        if len(name) == 6 and name[:3] == "<0x" and name[5] == ">":
            return bytes([int(name[3:5], 16)])
        return name.replace("▁", " ").encode()

    def both(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        wanted = (" " + text).encode()
        bytes_a, bytes_b = [bytes(byte_of[c] for c in names[i]) for i in a], [of_second(i) for i in b]
        if not text or b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
            return [], []
        return list(zip(a, map(len, bytes_a))), list(zip(b, map(len, bytes_b)))

    return both


def plain(docs, both):
    """Every step as the contract words it, token by token."""
    aligned = []
    for doc, text in docs:
        a, b = both(text or "")
        spans = []
        for tokens in (a, b):
            at, own = 0, []
            for i, size in tokens:
                own.append((i, at, at + size))
                at += size
            spans.append(own)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in spans[0]} & {y[2] for y in spans[1]})
        written, begin = [], 0
        for end in ends:
            inside = [",".join(str(i) for i, s, e in own if begin <= s and e <= end) for own in spans]
            written.append("|".join(inside))
            begin = end
        digest = hashlib.sha256(";".join(written).encode()).hexdigest() if a else ""
        aligned.append((doc, len(a), len(b), len(ends), links, digest))
    counts = Counter(link for row in aligned for link in row[4])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        (
            (doc, n_a, n_b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest)
            for doc, n_a, n_b, n, links, digest in aligned
        ),
        key=repr,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _rows(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def texts(prose):
    choose = random.Random(3)
    bits = ["the", " ", "  ", "\n", "\t", "é", "漢字", "ſ", "▁", "<s>", "<0x41>", "<|endoftext|>", "12", "don't", "A", "́", "🙂", "\x00", "x" * 40, "-", "."]
    out = [" ".join(prose(choose.randint(1, 80))) for _ in range(40)]
    out += ["".join(choose.choice(bits) + choose.choice(["", " "]) for _ in range(choose.randint(0, 15))) for _ in range(150)]
    return out + ["", None, " ", "the the the " * 300 + "end", "▁", "a ▁b", "\n"] + out[:5] * 2


def test_rows_are_those_of_the_libraries(spark, scratch, prose, libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "ENTRIES", 500)  # several blocks a task
    rows = [(i if i % 50 else None, t, i) for i, t in enumerate(texts(prose))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, pair long").repartition(3)
    found = token_alignment.align(frame, scratch, FIRST, SECOND)
    assert _rows(found) == plain([r[:2] for r in rows], libraries)


def test_no_rows(spark, scratch, docs):
    assert token_alignment.align(docs([]), scratch, FIRST, SECOND).count() == 0


def test_rows_without_tokens_only(spark, scratch, docs):
    found = token_alignment.align(docs([(1, None), (2, "")]), scratch, FIRST, SECOND)
    assert _rows(found) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_counts_of_pairs(spark, scratch, prose, libraries, docs):
    rows = list(enumerate(texts(prose)))
    stored = token_alignment.indexed(docs(rows), FIRST, SECOND).where("pair IS NOT NULL")
    found = {(r.pair >> 20, r.pair & (1 << 20) - 1): (r.n_docs, r.n_links) for r in token_alignment.pair_counts(stored).collect()}
    in_docs, links = Counter(), Counter()
    for _, text in rows:
        a, b = libraries(text or "")
        cut_a, cut_b = np.cumsum([s for _, s in a]), np.cumsum([s for _, s in b])
        own = Counter(
            (x[0], y[0]) for x, ex in zip(a, cut_a) for y, ey in zip(b, cut_b) if ex - x[1] < ey and ey - y[1] < ex
        )
        in_docs.update(own.keys())
        links.update(own)
    assert found == {p: (in_docs[p], links[p]) for p in links}


def test_index_with_dense_and_sparse_containers(spark):
    choose = np.random.default_rng(9)
    entries = {}
    for pair, share in ((3, 0.9), (7, 0.1), (8, 0.0001), (1 << 35, 0.0625)):
        for doc in np.flatnonzero(choose.random(pair_index.BLOCK_DOCS) < share).tolist():
            entries[pair, doc] = int(choose.choice([1, 1, 2, 3, 5, 70_000]))
    listed = list(entries)
    choose.shuffle(listed)
    pairs, docs = (np.array(c, np.int64) for c in zip(*listed))
    counts = np.array([entries[int(p), int(d)] for p, d in zip(pairs, docs)], np.int64)
    rows = pair_index.postings(pairs, docs, counts)
    assert max(len(c) for c in rows.column("docs").to_pylist()) == pair_index.BITMAP

    expected = {p: (sum(q == p for q, _ in entries), sum(n for (q, _), n in entries.items() if q == p)) for p in {p for p, _ in entries}}
    frame = spark.createDataFrame(rows.to_pandas(), "pair long, docs binary, planes array<binary>")
    found = frame.select("pair", pair_index.popcount(F.col("docs")).alias("d"), pair_index.occurrences(F.col("docs"), F.col("planes")).alias("n"))
    assert {r.pair: (r.d, r.n) for r in found.collect()} == expected

    weights = {p: i + 2 for i, p in enumerate(expected)}
    table = pa.Table.from_batches([rows]).append_column("w", pa.array([weights[p] for p in rows.column("pair").to_pylist()]))
    total = np.zeros(pair_index.BLOCK_DOCS, np.int64)
    for (p, d), n in entries.items():
        total[d] += n * weights[p]
    assert (pair_index.add_scores(table, ["w"], pair_index.BLOCK_DOCS)[0] == total).all()


def test_whole_table(spark, libraries):
    from cohortgram.llm.registry import op12_token_alignment

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    expected = {r[0]: r for r in plain(short, libraries)}
    found = {r[0]: r for r in _rows(op12_token_alignment(spark, sf_dir))}
    assert len(found) == len(rows)
    for doc, row in expected.items():
        # Counts are those of all documents, and the long ones are left out of the slow reading.
        assert found[doc][:5] == row[:5] and found[doc][7] == row[7] and found[doc][6] >= row[6]


def test_bitmaps_are_shuffled_to_their_block_alone(spark, scratch, prose, docs):
    found = token_alignment.align(docs(list(enumerate(texts(prose)))), scratch, FIRST, SECOND)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(lines) if re.search(r"Join \[pair#", line)]
    assert [("SortMergeJoin" in lines[i]) for i in joins] == [True]
    depth = [len(re.match(r"[\s:+\-*()0-9]*", line)[0]) for line in lines]
    (at,) = joins
    below = next((j for j in range(at + 1, len(lines)) if depth[j] <= depth[at]), len(lines))
    projected = [line for line in lines[at:below] if "Project" in line]
    assert projected and not any(re.search(r"docs#|planes#", line) for line in projected)
