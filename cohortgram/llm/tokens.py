"""Token ids of whole texts by the tokenizers library, with one library call per distinct piece of text.

Both vocabularies used here split a text into pieces by a pattern and merge inside each piece alone, so the ids
of a text are those of its pieces, in order. Pieces recur, so each worker keeps the ids of those it has seen
(``MEMO_PIECES``, then it starts over). New pieces go to the model of the tokenizer alone, which
does the merging; what the tokenizer does before, a byte-level spelling, is a translation of bytes. The pattern runs in another regular-expression library than the
tokenizer's own; texts with a character outside the range on which the two are tested to agree, and texts that
may hold a special token, go to the tokenizer whole.
"""

from __future__ import annotations

import array
import os
import re
from functools import lru_cache

from cohortgram.llm import memory

#: Pieces whose ids a worker remembers: some 200 bytes each.
MEMO_PIECES = 700_000
#: Outside it, or with "<|", the library splits the text itself.
UNUSUAL = re.compile("[^\t\n\r -~¡-¬®-±´-¸º»¿-ſ]|<\\|")
_USUAL_LATIN = bytes(b for b in range(256) if not UNUSUAL.search(chr(b)))
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
#: What the patterns of the two tokenizer files come to for the characters above, the commonest kind first.
BYTE_PATTERN = (
    rf" ?[{_LETTER}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\t\n\r 0-9{_LETTER}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)
WORD_PATTERN = rf"[{_LETTER}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t\n\r 0-9{_LETTER}]+"


class Pieces:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens inside texts are then ordinary text.
        self.tokenizer.encode_special_tokens = plain
        self._lowers = self.tokenizer.normalizer is not None
        self._find = re.compile(WORD_PATTERN if self._lowers else BYTE_PATTERN).findall
        self._memo = _Memo(self.tokenizer.model)

    def library(self, text: str) -> bytes:
        """The ids of one text, by the library alone."""
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes an id."""
        get, find = self._memo.__getitem__, self._find
        if self._lowers:
            return [self.library(t) if unusual(t) else b"".join(map(get, find(t.lower()))) for t in texts]
        return [self.library(t) if unusual(t) else b"".join(map(get, find(t))) for t in texts]


class _Memo(dict):
    """Ids of pieces by a tokenizer's model, of bounded size."""

    def __init__(self, model):
        self._merge = model.tokenize
        # Each byte as its character in the vocabulary, from Latin-1; printable ASCII is spelled as it is.
        self._spelling = dict(enumerate(byte_characters()))
        self._space = self._spelling[ord(" ")]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_PIECES:
            self.clear()
        if piece.isascii() and piece.isprintable():
            spelled = piece.replace(" ", self._space)
        else:
            spelled = piece.encode().decode("latin-1").translate(self._spelling)
        ids = self[piece] = _packed([t.id for t in self._merge(spelled)])
        return ids


def unusual(text: str) -> bool:
    """Whether a text goes to the library whole."""
    try:
        return bool(text.encode("latin-1").translate(None, _USUAL_LATIN)) or "<|" in text
    except UnicodeEncodeError:
        return UNUSUAL.search(text) is not None


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in kept]
    return [chr(b if b in kept else 256 + others.index(b)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return array.array("I", ids).tobytes()


@lru_cache(maxsize=4)
def pieces(path: str, plain: bool = False) -> Pieces:
    """One per worker and file."""
    return Pieces(path, plain)


memory.kept(pieces.cache_clear)
