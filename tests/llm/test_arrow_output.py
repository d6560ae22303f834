import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortgram.llm import arrow_output
from cohortgram.llm.registry import BYTE_BPE, BYTE_BPE_SIZE

PATH = public_tokenizers.path(BYTE_BPE)
LIBRARY = Tokenizer.from_file(PATH)


def expected(rows):
    at, out = 0, []
    for doc, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def write(frame, scratch, length=16):
    return arrow_output.write_sequences(frame, scratch, PATH, 0, BYTE_BPE_SIZE, length)


@pytest.fixture
def rows(prose):
    made = [(i, " ".join(prose(n))) for i, n in enumerate([0, 1, 30, 500, 3, 4000, 2, 90] * 4)]
    return [*made, (100, None), (101, ""), (102, "é 日本")]


def test_round_trip(spark, docs, rows, scratch):
    frame = docs([(*r, "x") for r in reversed(rows)], "doc_id long, text string, part string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write(frame, scratch, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = sorted(map(tuple, arrow_output.read_documents(manifest).collect()), key=lambda r: r[1])
    assert found == expected(rows)
    assert manifest.count() > 1


def test_sequences_have_one_length_and_a_mask(docs, rows, scratch):
    for file in write(docs(rows), scratch).collect():
        sequences = arrow_output.SequenceFile(file.path)
        assert sequences.length == 16 and sequences.real() == file.n_tokens
        batch = sequences.reader.get_batch(0)
        assert batch.schema.field("ids").type == pa.list_(pa.uint16(), 16)
        assert batch.schema.field("mask").type == pa.list_(pa.bool_(), 16)


def test_random_access_copies_nothing(docs, rows, scratch):
    file = max(write(docs(rows), scratch).collect(), key=lambda f: f.n_tokens)
    sequences = arrow_output.SequenceFile(file.path)
    before = pa.total_allocated_bytes()
    view = sequences.ids(100, 50)
    assert not view.flags.owndata and pa.total_allocated_bytes() == before
    assert np.array_equal(view, np.concatenate([sequences.ids(i, 1) for i in range(100, 150)]))


def test_a_cut_file_fails(docs, scratch):
    manifest = write(docs([(1, "some text")]), scratch)
    wrong = manifest.selectExpr("part", "path", "docs_path", "n_tokens + 1 AS n_tokens", "n_docs", "first")
    with pytest.raises(Exception, match="instead of"):
        arrow_output.read_documents(wrong).collect()


def test_repeated_rows_null_ids_and_no_rows(docs, scratch):
    found = arrow_output.read_documents(write(docs([(2, "b"), (None, "c"), (2, "b")]), scratch)).collect()
    assert sorted((r.start, r.doc_id) for r in found) == [(0, None), (2, 2), (4, 2)]


def test_no_rows(docs, scratch):
    assert arrow_output.read_documents(write(docs([]), scratch)).count() == 0
