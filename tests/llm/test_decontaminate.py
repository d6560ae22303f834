import random
from collections import Counter

import numpy as np
import pytest

from cohortgram.llm import decontaminate


def words(text):
    return decontaminate.words_of(text).tolist()


def shingles(of):
    size = decontaminate.SHINGLE
    return [tuple(of[i : i + size]) for i in range(max(1, len(of) - size + 1))] if of else []


def by_brute_force(text, items):
    """Similarity of the best window per item, over every window."""
    of, best = words(text), {}
    for item_id, item in items:
        own = words(item)
        wanted = Counter(shingles(own))
        for i in range(len(of) - len(own) + 1 if own else 0):
            here = Counter(shingles(of[i : i + len(own)]))
            score = sum((here & wanted).values()) / sum((here | wanted).values())
            if score >= decontaminate.THRESHOLD:
                best[item_id] = max(score, best.get(item_id, 0.0))
    return best


@pytest.fixture
def items(prose):
    return [(i, " ".join(prose(n))) for i, n in enumerate([3, 6, 12, 20, 20, 35, 35, 60])] + [(90, ""), (91, None)]


@pytest.fixture
def corpus(prose, items):
    choose = random.Random(4)
    rows = [" ".join(prose(choose.randint(0, 200))) for _ in range(20)]
    for _, item in items[:8]:
        for edits in (0, 1, 2, 5):
            copied = item.split()
            for _ in range(edits):
                copied[choose.randrange(len(copied))] = "edited"
            rows.append(" ".join([*prose(30), *copied, *prose(30)]).upper())
        rows.append(" ".join([*prose(9), *item.split()[:-1], "edited", *prose(9)]))
        rows.append(" ".join([*prose(9), "edited", *item.split()[1:], *prose(9)]))
        rows.append(" ".join([*prose(10), *item.split()[: len(item.split()) // 2], *prose(10)]))
    return list(enumerate(rows)) + [(1000, None), (1001, "")]


def found(frame):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in frame.collect()}


def test_agrees_with_all_windows(docs, corpus, items):
    expected = {(d, i): round(s, 9) for d, text in corpus for i, s in by_brute_force(text, items).items()}
    got = found(decontaminate.contaminated(docs(corpus), docs(items, "item_id long, text string")))
    assert got == expected and len(expected) > 15


def test_chunks_give_the_same(docs, corpus, items, monkeypatch):
    benchmark = docs(items, "item_id long, text string")
    whole = found(decontaminate.contaminated(docs(corpus), benchmark))
    folder = decontaminate.stored(benchmark)
    for name, value, limits in (("CHUNK_WORDS", 40, (500, 40)), ("CHUNK_ITEMS", 2, (2, 100_000))):
        with monkeypatch.context() as patch:
            patch.setattr(decontaminate, name, value)
            patch.setattr(decontaminate, "GATHER", 2000)
            parts = list(decontaminate.chunks(folder, *limits))
            assert len(parts) > 3 and sorted(i for p in parts for i, _ in p) == sorted(i for i, _ in items)
            assert found(decontaminate.contaminated(docs(corpus), benchmark)) == whole
            kept = decontaminate.clean(docs(corpus), benchmark)
            assert {r.doc_id for r in kept.collect()} == {d for d, _ in corpus} - {d for d, _ in whole}


def test_clean_keeps_rows_and_columns(docs, corpus, items):
    frame = docs([(*r, "x") for r in corpus], "doc_id long, text string, _hits string")
    got = decontaminate.clean(frame, docs(items, "item_id long, text string"))
    dirty = {d for d, text in corpus if by_brute_force(text, items)}
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, _ in corpus if d not in dirty)


def test_nothing_to_find(docs, items):
    nothing = docs([], "item_id long, text string")
    assert decontaminate.contaminated(docs([(1, "some text")]), nothing).count() == 0
    assert decontaminate.clean(docs([(1, "some text"), (1, "some text")]), nothing).count() == 2
    assert decontaminate.contaminated(docs([]), docs(items, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("size", [1, decontaminate._DIRECT - 1, decontaminate._DIRECT, 50])
def test_every_fingerprint_within_the_radius_is_found(size):
    random_ = np.random.default_rng(1)
    prints = random_.integers(0, 2**63, size, dtype=np.uint64)
    index = decontaminate._SizeIndex(prints, decontaminate._changes())
    for flips in (0, 5, decontaminate.RADIUS, decontaminate.RADIUS + 1):
        masks = [sum(1 << int(b) for b in random_.choice(64, flips, replace=False)) for _ in range(size)]
        near = index.near(prints ^ np.array(masks, np.uint64)).tolist()
        hits = {i for i, item in near if i == item}
        assert hits == (set(range(size)) if flips <= decontaminate.RADIUS else set())


def test_items_with_words_taken_out_and_nothing_around_them(docs, items):
    choose = random.Random(6)
    rows = []
    for _, item in items[:8]:
        of = item.split()
        rows += [" ".join(of[:-n]) for n in (1, 2, 6)] + [" ".join(of[1:]), " ".join(of[3:-3])]
        for taken in (1, 2):
            gone = set(choose.sample(range(len(of)), taken))
            rows.append(" ".join(w for i, w in enumerate(of) if i not in gone))
    expected = {}
    for d, text in enumerate(rows):
        of = words(text)
        for item_id, item in items:
            own = words(item)
            if not of or not own:
                continue
            n = min(len(of), len(own))
            wanted = Counter(shingles(own))
            windows = [Counter(shingles(of[i : i + n])) for i in range(len(of) - n + 1)]
            score = max(sum((w & wanted).values()) / sum((w | wanted).values()) for w in windows)
            if score >= decontaminate.THRESHOLD:
                expected[d, item_id] = round(score, 9)
    got = decontaminate.contaminated(docs(list(enumerate(rows))), docs(items, "item_id long, text string"))
    assert found(got) == expected and len(expected) > 15
    assert all(r.start == 0 and r.n_words == len(words(rows[r.doc_id])) for r in got.collect())
    assert not decontaminate.clean(docs([(1, rows[-7])]), docs(items, "item_id long, text string")).count()


@pytest.mark.parametrize("lengths", [[20] * 500, range(5, 505)], ids=["one_length", "all_lengths"])
def test_a_chunk_of_most_items_stays_within_its_bound(lengths):
    choose = random.Random(8)
    items = [(i, " ".join(str(choose.random())[2:] for _ in range(n))) for i, n in enumerate(lengths)]
    index = decontaminate.Benchmark(items[: decontaminate.CHUNK_ITEMS])
    held = sum(a.nbytes for size in index.indexes.values() for table in size.tables for a in table)
    assert held <= 120_000 * decontaminate.CHUNK_ITEMS
    assert [h["item_id"] for h in index.hits(items[77][1])] == [77]


def test_texts_are_looked_up_once(docs, corpus, items):
    got = decontaminate.contaminated(docs(corpus), docs(items, "item_id long, text string"))
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
