import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cohortgram.llm import packing
from cohortgram.llm.registry import WORD_BPE

PATH = public_tokenizers.path(WORD_BPE)


def best_fit_decreasing(lengths, size):
    """Room of each window, by looking at all of them."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms[rooms.index(min(fitting))] -= length
        else:
            rooms.append(size - length)
    return sorted(rooms)


def test_windows_are_those_of_best_fit_decreasing():
    choose = random.Random(1)
    for size in (1, 7, 64, 100):
        lengths = np.array([choose.randint(1, size) for _ in range(300)])
        sequence, offset = packing.pack_lengths(lengths, size)
        filled = np.bincount(sequence, weights=lengths)
        assert sorted((size - filled).astype(int).tolist()) == best_fit_decreasing(lengths.tolist(), size)
        for s in range(len(filled)):
            inside = sorted(zip(offset[sequence == s], lengths[sequence == s]))
            assert [o for o, _ in inside] == np.cumsum([0, *(n for _, n in inside[:-1])]).tolist()


def check(rows, pieces, size):
    tokenizer = Tokenizer.from_file(PATH)
    whole = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(whole)
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            ids = whole[doc][at : at + p.length]
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(whole[doc]), zlib.crc32(ids.tobytes()))
            at += p.length
        assert at == len(whole[doc])
    for inside in by_sequence.values():
        inside.sort(key=lambda p: p.offset)
        assert [p.offset for p in inside] == np.cumsum([0, *(p.length for p in inside[:-1])]).tolist()
        assert sum(p.length for p in inside) <= size


def test_every_id_lies_in_one_piece(docs, scratch, prose, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    choose = random.Random(2)
    rows = [(i, " ".join(prose(choose.randint(0, 300)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "<|startoftext|> É 日本 ́"), (503, " ".join(prose(9000)))]
    frame = docs([(*r, 1) for r in rows], "doc_id long, text string, place int")
    check(rows, packing.pack_documents(frame, scratch, PATH, 2, 256).collect(), 256)


def test_little_padding(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    filled = packing.pack_documents(docs, scratch, PATH, 2).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in filled) >= 0.99 * packing.WINDOW * len(filled)


def test_repeated_rows_null_ids_and_no_rows(docs, scratch):
    rows = [(1, "the same"), (1, "the same"), (None, "the same")]
    pieces = packing.pack_documents(docs(rows), scratch, PATH, 2).collect()
    assert sorted((p.doc_id or 0, p.length) for p in pieces) == [(0, 3), (1, 3), (1, 3)]
    assert len({(p.sequence_id, p.offset) for p in pieces}) == 3


def test_no_rows(docs, scratch):
    assert packing.pack_documents(docs([]), scratch, PATH, 2).count() == 0
