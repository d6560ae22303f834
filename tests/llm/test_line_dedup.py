import random

import numpy as np
import pytest

from cohortgram.llm import line_dedup
from cohortgram.plans.storage import Scratch


def runs(text):
    """(from, to, lines) of the shortest run of enough words at each line."""
    hashes, words = line_dedup.line_hashes(line_dedup.lines_of(text))
    out = []
    for i in range(len(hashes)):
        total = 0
        for j in range(i, len(hashes)):
            total += int(words[j])
            if total >= line_dedup.MIN_WORDS:
                out.append((i, j + 1, tuple(hashes[i : j + 1].tolist())))
                break
    return out


def blocks_by_brute_force(rows):
    """Per row the lines in runs that an earlier document has, and those lines with all equal neighbours."""
    seen, least = set(), []
    for _, text in sorted(rows):
        least.append({i for a, b, key in runs(text) if key in seen for i in range(a, b)})
        seen |= {key for _, _, key in runs(text)}
    return least


@pytest.fixture
def corpus(prose):
    choose = random.Random(8)

    def sentences(n):
        return [" ".join(prose(choose.randint(4, 12))) for _ in range(n)]

    passage, other, saying = sentences(8), sentences(6), sentences(1)
    rows = [" ".join(sentences(choose.randint(0, 12))) for _ in range(20)]
    for _ in range(15):
        own = sentences(6)
        cut = choose.randrange(1, 6)
        rows.append(" ".join([*own[:cut], *passage, *own[cut:]]))
    rows.append(" ".join([*other, *sentences(3), *passage]))
    rows.append(" ".join([*passage, *sentences(2), *other]))  # the blocks in another order
    rows += ["\n".join([*saying, *sentences(4)]) for _ in range(10)]
    rows += [rows[3], rows[25], rows[25].upper(), "", "short.", "..."]
    return list(enumerate(rows))


def test_lines_join_to_the_text():
    for text in ("", "a", "a.b\n\n c!? d\n", "\n\n", "no end", "é. ñ\x85x. y"):
        assert "".join(line_dedup.lines_of(text)) == text


def test_shared_blocks_go_and_nothing_else(docs, corpus, scratch):
    found = line_dedup.without_shared_blocks(docs(corpus), scratch).collect()
    expected = blocks_by_brute_force(corpus)
    everything = [line_dedup.line_hashes(line_dedup.lines_of(t))[0].tolist() for _, t in corpus]
    assert sum(map(bool, expected)) > 15
    for row in found:
        lines = line_dedup.lines_of(corpus[row.doc_id][1])
        kept = line_dedup.lines_of(row.text)
        gone = len(lines) - len(kept)
        assert row.n_lines == len(lines) and row.n_deleted == gone >= len(expected[row.doc_id])
        if not expected[row.doc_id]:
            assert row.text == corpus[row.doc_id][1]
        earlier = {h for lines in everything[: row.doc_id] for h in lines}
        left = [h for h in everything[row.doc_id]]
        for h in line_dedup.line_hashes(kept)[0].tolist():
            left.remove(h)
        assert set(left) <= earlier


def test_alignment_keeps_the_order_of_both():
    """All lines are runs of their own and unique, so the anchors are a longest common subsequence."""
    choose = random.Random(9)
    for _ in range(200):
        a = choose.sample(range(30), 20)
        b = sorted(a, key=lambda x: a.index(x) + choose.random() * 6)[: choose.randint(5, 20)]
        runs_a, runs_b = ([(i, i + 1, x) for i, x in enumerate(side)] for side in (a, b))
        blocks = line_dedup.patience(a, b, [r for r in runs_a if r[2] in b], runs_b)
        taken = [a[i] for x, y in blocks for i in range(x, y)]
        assert sorted(taken, key=b.index) == taken
        table = np.zeros((21, len(b) + 1), int)
        for i in range(20):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert len(taken) == table[-1, -1]


def test_without_the_alignment_nothing_goes(monkeypatch):
    rows = [line_dedup.line_hashes(lines("p", 8, 8, 8, 8)) for _ in range(2)]
    (later, words), (earlier, _) = rows
    assert line_dedup.shared_blocks(later, words, earlier) == [(0, 4)]
    monkeypatch.setattr(line_dedup, "patience", lambda *_: [])
    assert line_dedup.shared_blocks(later, words, earlier) == []


def test_blocks_of_any_two_documents_against_all_common_blocks():
    """Few lines, so that they repeat, move and overlap in every way."""
    choose = random.Random(12)
    pool = lines("p", 3, 6, 9, 11, 21, 0, 1)
    for _ in range(600):
        texts = ["\n".join(choose.choice(pool) for _ in range(choose.randint(0, 14))) for _ in range(2)]
        (earlier, _), (later, words) = (line_dedup.line_hashes(line_dedup.lines_of(t)) for t in texts)
        found = {i for x, y in line_dedup.shared_blocks(later, words, earlier) for i in range(x, y)}
        assert found == in_common_blocks(texts)[1]


def test_null_ids_repeated_rows_and_clashing_names(docs, scratch, prose):
    text = " ".join(prose(40))
    rows = [(5, text), (5, text), (None, text), (7, text), (3, None), (9, f"Before it. {text}")]
    frame = docs([(*r, 1, "b") for r in rows], "doc_id long, text string, n_lines int, blocks string")
    got = line_dedup.without_shared_blocks(frame, scratch)
    assert got.columns == ["doc_id", "text", "blocks", "n_lines", "n_deleted"]
    found = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert found == sorted([(5, text), (5, text), (None, text), (7, ""), (3, None), (9, "Before it. ")], key=repr)


@pytest.mark.parametrize("name", ["_doc", "_version", "_blocks", "_done", "_DOC", "version", "n_Lines_", "start"])
def test_columns_of_any_name_are_kept(docs, scratch, prose, name):
    text = " ".join(prose(40))
    frame = docs([(1, text, 7), (2, text + " More of it.", None), (3, None, 9)], f"doc_id long, text string, `{name}` long")
    got = line_dedup.without_shared_blocks(frame, scratch)
    assert got.columns == [*frame.columns, "n_lines", "n_deleted"]
    assert sorted(((r.doc_id, r[2]) for r in got.collect())) == [(1, 7), (2, None), (3, 9)]


def test_no_rows(docs, scratch):
    assert line_dedup.without_shared_blocks(docs([]), scratch).count() == 0


def deleted(docs, scratch, *texts):
    """The lines that go from the last of the texts."""
    found = line_dedup.without_shared_blocks(docs(list(enumerate(texts))), scratch).collect()
    row = next(r for r in found if r.doc_id == len(texts) - 1)
    lines, kept = line_dedup.lines_of(texts[-1]), line_dedup.lines_of(row.text)
    assert row.n_deleted == len(lines) - len(kept)
    return [line.strip() for line in lines if line not in kept]


def lines(name, *sizes):
    return [" ".join(f"{name}{i}w{k}" for k in range(n)) + "." for i, n in enumerate(sizes)]


@pytest.mark.parametrize("copies", [1, 2])
def test_all_copies_of_a_passage_go(docs, scratch, copies):
    passage, own = lines("p", 3, 10, 12, 24), lines("o", *[5] * 8)
    later = [own[0], *passage, own[1], *passage, own[2], *passage, own[3]]
    earlier = [own[4], *(passage + own[5:6]) * copies, own[6]]
    assert deleted(docs, scratch, " ".join(earlier), " ".join(later)) == passage * 3


def test_a_passage_in_another_order_than_short_common_lines_goes(docs, scratch):
    passage, common = lines("p", 15, 15, 15, 15), lines("s", 4, 4, 4, 4, 4)
    x, y = lines("x", *[5] * 5), lines("y", *[5] * 6)
    earlier = [*passage, *(line for pair in zip(x, common) for line in pair)]
    later = [*(line for pair in zip(common, y) for line in pair), y[5], *passage]
    # Lines on both sides keep the passage from being a common prefix or suffix.
    assert deleted(docs, scratch, " ".join(["Before it.", *earlier]), " ".join([*later, "After it."])) == passage


def in_common_blocks(texts):
    """Per text its lines in any block of enough words that an earlier text has, over all places of both."""
    hashed = [line_dedup.line_hashes(line_dedup.lines_of(t)) for t in texts]
    out = []
    for d, (a, words) in enumerate(hashed):
        gone = set()
        for b, _ in hashed[:d]:
            for i in range(len(a)):
                for j in range(len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                        k += 1
                    if words[i : i + k].sum() >= line_dedup.MIN_WORDS:
                        gone |= set(range(i, i + k))
        out.append(gone)
    return out


def test_a_block_longer_than_the_first_holder_has(docs, scratch):
    block, own = lines("p", 8, 8, 8, 3), lines("o", *[5] * 6)
    texts = [[own[0], *block[:3], own[1]], [own[2], *block, own[3]], [own[4], *block, own[5]]]
    assert deleted(docs, scratch, *map(" ".join, texts)) == block


def test_agrees_with_all_common_blocks(docs, scratch):
    choose = random.Random(10)
    pool = [*lines("p", *[choose.randint(1, 14) for _ in range(12)]), "...\n", lines("q", 25)[0]]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(choose.randint(0, 4)):
            at = choose.randrange(len(pool))
            parts += [*pool[at : at + choose.randint(1, 6)], choose.choice(pool), f"own{choose.random()} line."]
        texts.append(" ".join(parts))
    expected = in_common_blocks(texts)
    for row in line_dedup.without_shared_blocks(docs(list(enumerate(texts))), scratch).collect():
        kept = [line for i, line in enumerate(line_dedup.lines_of(texts[row.doc_id])) if i not in expected[row.doc_id]]
        assert row.text == "".join(kept) and row.n_deleted == len(expected[row.doc_id])
    assert sum(map(bool, expected)) > 10


def test_texts_are_cut_once_under_a_filter(spark, docs):
    found = line_dedup.without_shared_blocks(docs([(1, "one line"), (2, None)]), Scratch(spark)).where("n_deleted = 0")
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert found.count() == 2
