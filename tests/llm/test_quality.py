import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortgram.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    return quality.classify(docs, labels).join(labels, "doc_id", "left").toPandas()


def test_held_out_accuracy(scored):
    out = scored[scored.held_out & scored.quality.notna()]
    good, bad = out[out.quality == 1].score.to_numpy(), out[out.quality == 0].score.to_numpy()
    assert len(good) > 30 and len(bad) > 5
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert ((out.predicted == out.quality).mean()) > 0.95


def test_every_row_is_scored(scored):
    assert len(scored) == 1000 and scored.score.between(0, 1).all()
    assert (scored.predicted == (scored.score >= 0.3)).all()
    assert (scored.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in scored.doc_id]).all()


def test_scores_repeat(spark, scored):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    again = quality.classify(docs.repartition(7), labels.repartition(3)).toPandas()
    assert np.allclose(again.sort_values("doc_id").score, scored.sort_values("doc_id").score)


def test_gradients():
    texts = [b"Some words here. " * 40, b"WORSE!! " * 100, b"", b"| a | b | c " * 30]
    bags = [quality.passages(t) for t in texts]
    x, starts = np.concatenate(bags), np.cumsum([0, *map(len, bags[:-1])])
    labels = np.array([1.0, 0.0, 1.0, 0.0])
    model = quality.AttentionModel(np.nanmean(x, axis=0), np.nanstd(x, axis=0) + 1e-3)

    def loss():
        p = model.score(x, starts)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, slope in model.gradients(x, starts, labels).items():
        at = tuple(0 for _ in slope.shape)
        kept = model.weights[name][at]
        sides = []
        for step in (1e-5, -1e-5):
            model.weights[name][at] = kept + step
            sides.append(loss())
        model.weights[name][at] = kept
        assert np.isclose(slope[at], (sides[0] - sides[1]) / 2e-5, atol=1e-7)


def test_passages_cover_the_whole_text():
    assert quality.passages(b"").shape == quality.passages(b" \n ").shape == (1, quality.FEATURES)
    assert len(quality.passages(b"word " * (quality.PASSAGE * 3))) == 3
    assert len(quality.passages(b"word " * (quality.PASSAGE * 3 + 1))) == 4
    assert len(quality.passages(b"x" * 2_000_000)) == 1
    repeated, varied = (quality.passages(t)[0, -4:-2] for t in (b"a " * 64, " ".join(map(str, range(64))).encode()))
    assert repeated[0] > 0.9 and varied[0] == 0 and varied[1] == 1 and repeated[1] < 0.1


def test_odd_rows_and_clashing_names(docs):
    rows = [(1, None), (1, None), (None, "A text. " * 20), (3, "x" * 100_000), (4, "")]
    frame = docs([(*r, 0.0) for r in rows], "doc_id long, text string, _score double")
    labels = docs([(1, 1), (None, 0), (3, None), (99, 0)], "doc_id long, quality int")
    found = quality.classify(frame, labels).collect()
    assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    kept = quality.accepted(frame, labels)
    assert kept.columns == frame.columns and kept.count() == 5


def test_labels_of_one_kind_or_none(docs):
    frame = docs([(i, f"text number {i}.") for i in range(20)])
    assert {r.score for r in quality.classify(frame, docs([], "doc_id long, quality int")).collect()} == {0.5}
    ones = docs([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert len({r.score for r in quality.classify(frame, ones).collect()}) == 1
    assert quality.classify(docs([]), ones).count() == 0


def test_training_takes_whole_documents_within_the_budget(docs, monkeypatch):
    sizes = {i: n for i, n in enumerate([40, 8, 30, 1, 25, 40, 3, 12, 20, 2, 17, 5])}
    frame = docs([(i, "\n".join([f"word{i} " * quality.PASSAGE] * n)) for i, n in sizes.items()])
    labels = docs([(i, i % 2) for i in sizes], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bags, kinds: seen.append(sorted(map(len, bags))))
    trained = [r.doc_id for r in labels.where(~quality.held_out()).orderBy(F.xxhash64("doc_id")).collect()]
    quality.train(frame, labels)
    assert seen.pop() == sorted(sizes[i] for i in trained) and max(sizes[i] for i in trained) > 16
    monkeypatch.setattr(quality, "BUDGET", 60, raising=False)
    quality.train(frame, labels)
    expected, left = [], 60
    for i in trained:
        if sizes[i] <= left:
            expected.append(sizes[i])
            left -= sizes[i]
    assert seen.pop() == sorted(expected) and len(expected) < len(trained)
