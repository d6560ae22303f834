"""Token counts and ids against the tokenizers library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortgram.llm import token_count, tokens
from cohortgram.llm.registry import BYTE_BPE, WORD_BPE

ODD = [
    "",
    " ",
    "\n\n \t x",
    "it's IT'S we'll 'd''ve",
    "a<|endoftext|>b<|endoftext|>",
    "<|startoftext|><|endoftext|",
    "naïve café œuvre ß ﬁ ½ ² ٣ ४ Ⅷ 日本語 한국 🙂👍🏽 ́ ​ x\u0085y",
    "x" * 20_000,
    "ab " * 30_000,
    "  leading   and   inner    spaces  ",
    *(f"a{x}b c{y}{x}d{x}{y} e{y}" for x in (" ", "\n", "\t", " \n", "\n ", "\r\n", "  ") for y in ("", "x", "\n", ".")),
    "1234567 1.5e-3 a1b2",
    "﻿\x00\x1c\x1d z",
]


@pytest.fixture(scope="module", params=[BYTE_BPE, WORD_BPE])
def both(request):
    path = public_tokenizers.path(request.param)
    return tokens.Pieces(path), Tokenizer.from_file(path)


def ids(library, text):
    return tokens._packed(library.encode(text, add_special_tokens=False).ids)


def test_ids_of_odd_texts(both):
    pieces, library = both
    assert pieces.encode(ODD) == [ids(library, t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_ids_of_any_text(both, texts):
    pieces, library = both
    assert pieces.encode(texts) == [ids(library, t) for t in texts]


def test_every_character_of_the_fast_path(both):
    pieces, library = both
    usual = [chr(c) for c in range(0x300) if not tokens.UNUSUAL.search(chr(c))]
    texts = [t for c in usual for t in (c, f"a{c}b", f" {c} ", c * 3, f"1{c}'s {c}\n\n x", f"{c}'re", f"x {c} {c}y z{c} {c}{c}")]
    assert len(usual) > 300 and pieces.encode(texts) == [ids(library, t) for t in texts]


def test_a_full_memo_starts_over(both, monkeypatch):
    pieces, library = both
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    texts = [f"word{i} other thing {i}" for i in range(30)]
    for i in range(0, 30, 3):
        assert pieces.encode(texts[i : i + 3]) == [ids(library, t) for t in texts[i : i + 3]]


COUNTER = token_count.Counter(public_tokenizers.path(BYTE_BPE))
LIBRARY = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_counts_of_any_text(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_counts_of_odd_texts(docs):
    rows = [*enumerate(ODD), (100, None)]
    frame = docs([(*r, "x") for r in [*rows, (5, ODD[5])]], "doc_id long, text string, n_tokens string")
    found = token_count.count_tokens(frame, public_tokenizers.path(BYTE_BPE)).collect()
    expected = [(i, len((t or "").encode()), len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in [*rows, (5, ODD[5])]]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert token_count.count_tokens(docs([]), public_tokenizers.path(BYTE_BPE)).count() == 0
