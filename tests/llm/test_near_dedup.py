import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortgram.llm import near_dedup
from cohortgram.llm.components import components
from cohortgram.plans.storage import Scratch


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def by_brute_force(rows):
    """(n_shingles, component, kept) of each row; all pairs are compared."""
    sets = [shingles(text) for _, text in rows]
    reach = list(range(len(rows)))

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                reach[root(i)] = root(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[root(i)] = min(doc, smallest.get(root(i), doc))
    found = [smallest.get(root(i)) if sets[i] else rows[i][0] for i in range(len(rows))]
    return sorted(((d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, found)), key=repr)


@pytest.fixture
def corpus(prose):
    """Single documents, copies, near copies of near copies, and a family around the threshold."""
    choose = random.Random(3)
    rows = [" ".join(prose(choose.randint(1, 120))) for _ in range(60)]
    for text in rows[:12]:
        words = text.split()
        for _ in range(6):
            words = list(words)
            words[choose.randrange(len(words))] = "changed"
            rows.append(" ".join(words).upper() if choose.random() < 0.2 else " ".join(words))
    base = prose(200)
    for edits in range(40):
        words = list(base)
        for _ in range(edits // 4):
            words[choose.randrange(len(words))] = f"edit{choose.randrange(1000)}"
        rows.append(" ".join(words))
    rows += [rows[0], rows[0], "", None, " \t\n", "one", "One", "two words", "a b c d", "a b c d e"]
    choose.shuffle(rows)
    return [(7 * i % 1009, text) for i, text in enumerate(rows)]


def columns(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_agrees_with_all_pairs(docs, corpus, scratch):
    frame = docs(corpus)
    assert columns(near_dedup.near_duplicates(frame, scratch, size=4)) == by_brute_force(corpus)


def test_null_ids_repeated_rows_and_clashing_names(docs, scratch, prose):
    text, other = " ".join(prose(50)), " ".join(prose(50))
    rows = [(None, text), (5, text), (5, text), (3, other), (None, None), (None, "alone here now and then")]
    frame = docs([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, class long, bucket string, n long")
    assert columns(near_dedup.near_duplicates(frame, scratch, size=4)) == sorted(
        [(None, 47, 5, False), (5, 47, 5, True), (5, 47, 5, True), (3, 47, 3, True), (None, 0, None, True), (None, 2, None, True)],
        key=repr,
    )


def test_no_rows(spark, docs):
    assert near_dedup.near_duplicates(docs([]), Scratch(spark)).count() == 0
    assert near_dedup.without_copies(docs([]), Scratch(spark)).count() == 0


def test_one_row_of_each_group_stays(docs, scratch, prose):
    words = prose(80)
    near = [*words[:-1], "other"]
    rows = [(4, " ".join(words)), (2, " ".join(near)), (2, " ".join(near)), (9, ""), (8, ""), (7, None), (1, "quite short")]
    frame = docs([(*r, "kept") for r in rows], "doc_id long, text string, component string")
    got = near_dedup.without_copies(frame, scratch)
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 7, 8, 9]


@pytest.mark.parametrize("name", ["_id", "_version", "_place", "_ID", "version", "row", "doc"])
def test_columns_of_any_name_are_kept(docs, scratch, prose, name):
    text = " ".join(prose(40))
    frame = docs([(1, text, 7), (2, text, 8), (3, None, None), (4, "other", None)], f"doc_id long, text string, `{name}` long")
    got = near_dedup.without_copies(frame, scratch)
    assert got.columns == frame.columns
    assert sorted((r.doc_id, r[2]) for r in got.collect()) == [(1, 7), (3, None), (4, None)]


def test_tables_pair_the_groups_of_two_collections():
    first = np.arange(32, dtype=np.uint32)
    second = first.copy()
    second[:2] += 100  # one group of the first collection
    equal = (near_dedup.table_keys(first) == near_dedup.table_keys(second)).reshape(near_dedup.GROUPS, near_dedup.GROUPS)
    assert not equal[0].any() and equal[1:].all()
    assert len(set(near_dedup.table_keys(first).tolist())) == near_dedup.GROUPS**2


def test_components_of_a_long_path(spark, scratch):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(
        spark.createDataFrame([(900, 901), (901, 900), (5, 5)], "a long, b long")
    )
    found = {r.vertex: r.component for r in components(edges, scratch, "path").collect()}
    assert found == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}
