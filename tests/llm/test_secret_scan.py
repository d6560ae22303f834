import hashlib
import random
import re

import numpy as np
import pytest

from cohortgram.llm import secret_scan
from cohortgram.llm.automaton import Automaton, Rule

#: The contract's expressions, with the fewest characters of the whole match or of its second group.
PLAIN = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
BITS = [
    "password", "passwd", "PassWord", "secret", "token", "TOKEN", "api_key", "apikey", "api__key", "AKIA", "AKI", "A", "=", ":", " ", "  ",
    '"', "'", "-", ".", "/", "\n", ",", "é", "漢", "ſecret", "deadbeef", "0123456789", "abcdef0123456789", "ZZ9", "Q7X8Y9Z0W1V2U3", "ghp_", "://", "@", "x",
    "eyJ", "-----BEGIN ", "PRIVATE KEY-----", "xoxb-", "AIza",
]


def plain_spans(text):
    found = []
    for order, (kind, (rule, group, least)) in enumerate(PLAIN.items()):
        for m in rule.finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def noise(seed, count):
    choose = random.Random(seed)
    return ["".join(choose.choice(BITS) for _ in range(choose.randint(0, 60))) for _ in range(count)]


@pytest.fixture(scope="module")
def automaton():
    return Automaton(secret_scan.RULES)


def test_base_spans_are_those_of_the_plain_expressions(automaton):
    texts = noise(1, 3000)
    kinds = [r.kind for r in automaton.rules]
    for text, own in zip(texts, secret_scan.spans_of([t.encode() for t in texts], automaton)):
        base = [f"{kinds[r]}:{s}:{e}" for s, r, e in own if r < 3]
        assert base == plain_spans(text), text


def test_every_rule_finds_what_the_expression_finds(automaton):
    texts = noise(2, 2000) + [
        "ghp_" + "a1B2" * 9, "xoxb-123456789012-abc", "sk_live_0123456789abcdefXYZ", "AIza" + "b" * 35, "ASIA" + "Z" * 16,
        "eyJhbGciOi.eyJzdWIiOi.SflKxwRJ_-x", "a -----BEGIN RSA PRIVATE KEY----- b", "ghp_xoxb-sk_live_AIza1",
    ]
    found = secret_scan.spans_of([t.encode() for t in texts], automaton)
    seen = set()
    for number, rule in enumerate(automaton.rules):
        if rule.kind == "assign":
            continue
        expression = re.compile(rule.rule, (re.I if rule.any_case else 0) | re.A)
        for text, own in zip(texts, found):
            spans = [(s, e) for s, r, e in own if r == number]
            matches = [m for m in expression.finditer(text)]
            assert set(spans) <= {m.span() for m in matches}
            seen.update(rule.kind for _ in spans)
            assert spans == [m.span() for m in matches if len(_tail(expression, m[0])) >= rule.least], (rule, text)
    assert {"vendor", "signed", "pem", "hex", "access"} <= seen


def _tail(expression, matched):
    """The bytes from the first place at which the match could end."""
    for end in range(1, len(matched) + 1):
        if expression.fullmatch(matched[:end]):
            return matched[end - 1 :]
    raise AssertionError(matched)


def test_pieces_and_neighbours_do_not_change_a_text(automaton):
    texts = [t.encode() for t in noise(3, 300)]
    alone = [secret_scan.spans_of([t], automaton)[0] for t in texts]
    assert secret_scan.spans_of(texts, automaton) == alone
    glued = "password" * 400 + "=" + "f" * 5000 + "," + "0" * 3000
    assert [f"{automaton.rules[r].kind}:{s}:{e}" for s, r, e in secret_scan.spans_of([glued.encode()], automaton)[0]] == plain_spans(glued)


def test_states_are_minimal(automaton):
    """No two states say the same of every continuation."""
    block = np.unique(automaton.marks, axis=0, return_inverse=True)[1].ravel()
    for _ in range(len(block)):
        block = np.unique(np.column_stack([block, block[automaton.table]]), axis=0, return_inverse=True)[1].ravel()
    assert len(np.unique(block)) == len(automaton.table)


@pytest.mark.parametrize("rule", ["a?", "ab(cd)?", "a.*b|b", "(a", "[ab"])
def test_rules_that_need_another_search_are_refused(rule):
    with pytest.raises(ValueError):
        Automaton([Rule("odd", rule)])


def test_rows_nulls_and_names(spark, rows):
    data = [
        (1, "token: abcdefghijkl", "x"), (1, "token: abcdefghijkl", "x"), (2, None, None), (3, "", "y"), (None, "AKIA" + "0" * 14, "z"),
        (4, "é" * 3 + " 漢 secret='0123456789abcdef' end", None), (5, "password=" + "a" * 200_000, "w"),
    ]
    frame = spark.createDataFrame(data, "doc_id long, text string, spans string")
    found = secret_scan.scan(frame).collect()
    assert len(found) == len(data)
    expected = {(d, ",".join(plain_spans(t or ""))) for d, t, _ in data}
    assert {(r.doc_id, r.spans) for r in found} == expected
    for row in found:
        assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()
        kinds = [s.split(":")[0] for s in row.spans.split(",")]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds.count(k) for k in PLAIN)
    assert secret_scan.scan(frame.where("false")).count() == 0


def test_whole_table(spark):
    """The query's rows against the plain expressions, on every document of the smallest tables."""
    from cohortgram.llm.registry import op11_secret_scan

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op11_secret_scan(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        base = ",".join(plain_spans(texts[row.doc_id] or ""))
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
