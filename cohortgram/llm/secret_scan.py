"""Secrets in texts, by one automaton for all rules.

The rules of ``RULES`` are compiled together (``automaton``): every text is read once, byte by byte, whatever the number of
rules. A match is the leftmost, longest one of its rule that does not overlap an earlier one of the same rule; matches of
different rules may overlap. Matches with too few bytes in their last part are dropped after they have been made, so that they still take
up their place. Rules are in ASCII and letters are those of ASCII; where a rule takes either case, A-Z and a-z are alike.

``spans`` of a row are ``kind:start:end``, in code points, end exclusive, ordered by start, then by the order of the rules. The first
three rules are the base; the others add known forms of keys.

One pass over the rows without a shuffle; a task holds a few MB of text and the transition arrays. Texts are scanned whole. A
null or empty text has no spans; rows are returned one for one, repeated rows and null ids included. No rows give no rows. Columns
besides ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm.automaton import Automaton, Rule, cached
from cohortgram.llm.text import sliced, texts_of

BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 14),
    Rule("hex", r"[0-9a-f]+", 16),
)
RULES = (
    *BASE,
    Rule("vendor", r"(gh(p|o|u|s|r)_|xox(b|p|a|r|s)-|(sk|rk)_(live|test)_|AIza|ASIA)[A-Za-z0-9_-]+", 14),
    Rule("signed", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 8),
    Rule("pem", r"-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
)

#: Bytes of text scanned together: more of them make the steps cheaper.
SLICE = 4 << 20

FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
_NAMES = [c.split()[0] for c in FOUND.split(", ")]
_automaton = cached(lambda: Automaton(RULES))


def spans_of(texts: list[bytes], automaton: Automaton) -> list[list[tuple[int, int, int]]]:
    """Per text its matches as ``(start, rule, end)`` in code points, in order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = b"".join(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    # Empty texts share their place with the next one and hold nothing.
    full = np.flatnonzero(sizes)
    matches = automaton.matches(data, starts[full])
    owners = full[np.searchsorted(starts[full], [m[1] for m in matches], "right") - 1].tolist() if matches else []
    before: dict[int, np.ndarray] = {}
    for owner, (rule, start, end) in zip(owners, matches):
        text, first = texts[owner], int(starts[owner])
        start, end = start - first, end - first
        if not text.isascii():
            if owner not in before:
                lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
                before[owner] = np.concatenate([[0], np.cumsum(lead)])
            start, end = int(before[owner][start]), int(before[owner][end])
        found[owner].append((start, rule, end))
    for own in found:
        own.sort()
    return found


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, the digest of the base spans, and all spans."""

    def look(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        kinds = [r.kind for r in automaton.rules]
        for batch in sliced(rows, SLICE):
            out = []
            for doc, own in zip(batch.column("doc_id").to_pylist(), spans_of(texts_of(batch.column("text")), automaton)):
                written = [f"{kinds[rule]}:{start}:{end}" for start, rule, end in own]
                base = ",".join(w for w, (_, rule, _) in zip(written, own) if rule < len(BASE))
                counts = [sum(rule == i for _, rule, _ in own) for i in range(len(BASE))]
                out.append((doc, *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(written)))
            columns = list(zip(*out))
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:]]
            yield pa.record_batch(arrays, names=_NAMES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(look, FOUND)
