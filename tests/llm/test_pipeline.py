"""The pipeline against plain Python over all pairs, windows and documents of the smallest table."""

import importlib.util
import sys
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from cohortgram.llm import decontaminate, line_dedup, near_dedup, quality
from cohortgram.llm.registry import queries
from cohortgram.plans.storage import Scratch

SMALL = "/root/testdata/sf0.001"


def neighbour(name):
    """Another test module of this folder."""
    path = Path(__file__).with_name(f"{name}.py")
    spec = importlib.util.spec_from_file_location(f"llm_{name}", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, scratch.keep(name, stage(spark, docs, SMALL))
        out[name] = before.toPandas(), docs.toPandas()
        if name != "packing":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_quality_keeps_what_the_model_accepts(spark, stages):
    before, after = stages["quality"]
    model = quality.train(spark.createDataFrame(before), spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = [model.score(x := quality.passages(t.encode()), np.array([0]))[0] for t in before.text]
    assert sorted(after.doc_id) == sorted(before.doc_id[np.array(scores) >= quality.CUT])
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = set(after.doc_id)
    right = [(d in kept) == bool(q) for d, q in labels.items() if d in set(before.doc_id)]
    assert np.mean(right) > 0.93


def test_line_dedup_deletes_what_was_there_before(stages):
    before, after = stages["line_dedup"]
    expected = neighbour("test_line_dedup").blocks_by_brute_force(list(zip(before.doc_id, before.text)))
    left = after.set_index("doc_id")
    for (doc, text), gone in zip(sorted(zip(before.doc_id, before.text)), expected):
        lines = line_dedup.lines_of(text)
        if not gone:
            assert left.text[doc] == text
        elif doc in left.index:
            assert left.n_chars[doc] == len(left.text[doc]) < len(text)
            assert len(lines) - len(line_dedup.lines_of(left.text[doc])) >= len(gone)
        else:
            assert not any(line.strip(" .!?\n") for i, line in enumerate(lines) if i not in gone) or len(gone) > 0


def test_near_dedup_keeps_the_first_of_each_group(stages):
    before, after = stages["near_dedup"]
    sets = [set(near_dedup.shingle_set(t.encode(), 5, True).tolist()) for t in before.text]
    order = sorted(range(len(sets)), key=lambda i: before.doc_id[i])
    group = {i: i for i in order}
    for x, i in enumerate(order):
        for j in order[:x]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                old, new = max(group[i], group[j], key=order.index), min(group[i], group[j], key=order.index)
                group = {k: new if g == old else g for k, g in group.items()}
    assert sorted(after.doc_id) == sorted(before.doc_id[i] for i in order if group[i] == i)


def test_decontamination_drops_what_holds_an_item(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    plain = neighbour("test_decontaminate").by_brute_force
    known = {s for _, item in items for s in neighbour("test_decontaminate").shingles(decontaminate.words_of(item).tolist())}
    suspects = [t for t in before.text if known & set(neighbour("test_decontaminate").shingles(decontaminate.words_of(t).tolist()))]
    dirty = {t for t in suspects if plain(t, items)}
    assert dirty and sorted(after.doc_id) == sorted(before.doc_id[~before.text.isin(dirty)])


def test_packing_packs_what_is_left(stages):
    before, after = stages["packing"]
    neighbour("test_packing").check(list(zip(before.doc_id, before.text)), list(after.itertuples()), 4096)


def test_odd_rows_pass_every_stage(spark):
    """Nulls in every column, empty and long texts, repeated rows, names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, version long, _hits string, place int, _id long, _version long, _place long, _doc long, _blocks string, n_lines long"
    rows = [
        (None,) * 14,
        (1, "", "en", "s", 0, 1, "x", 1, 5, 6, 7, 8, "b", 9),
        (2, "One short text.", "en", "s", 15, 1, "x", 1, 5, 6, 7, 8, "b", 9),
        (2, "One short text.", "en", "s", 15, 1, "x", 1, 5, 6, 7, 8, "b", 9),
        (3, "Words that go on and on here. " * 8000, "en", "s", 240000, 1, "x", 1, 5, 6, 7, 8, "b", 9),
    ]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, Scratch(spark).keep(name, stage(spark, docs, SMALL))
            assert name == "packing" or docs.columns == before.columns
            if given and name != "packing":
                kept = docs.where("doc_id = 2").first()
                assert tuple(kept[-8:]) == ("x", 1, 5, 6, 7, 8, "b", 9)
        assert docs.count() == 0 if not given else docs.where("doc_id = 2").count() == 1


def test_query(spark):
    frame = queries()["pipeline"](spark, SMALL)
    assert frame.columns[:3] == ["doc_id", "start", "length"] and frame.count() > 100


def test_registered_queries_name_every_operator():
    assert sorted(n.split("_")[0] for n in queries()) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert "corpus_pipeline" in sys.modules
