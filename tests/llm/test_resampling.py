import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortgram.llm import resampling
from cohortgram.llm.radix_sort import places, unsigned

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_buckets(text):
    words = WORDS.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain(docs, target):
    """Every step as the contract words it, over lists."""
    own = [(i, *plain_buckets(t)) for i, t in docs]
    s = Counter(b for _, _, bs in own for b in bs)
    t = Counter(b for text in target for b in plain_buckets(text)[1])
    source, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (source + 10000) / ((s[b] + 1) * (wanted + 10000))))

    rows = []
    for doc, n, bs in own:
        weight = sum(map(gain, bs))
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(bs), weight, score, n))
    drawn = 5 * sum(r[4] >= 20 for r in rows) // 100
    order = sorted((r for r in rows if r[4] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    ranks = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(order)]
    return ranks + [(*r[:4], None) for r in rows if r[4] < 20 or r[0] is None]


def _rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_buckets_are_those_of_whole_runs():
    choose = random.Random(4)
    words = ["a", "Bc", "é漢", "x" * 63, "x" * 64, "y" * 65, "z" * 300, "42", "the", "of"]
    texts = [choose.choice([" ", ", ", "\n"]).join(choose.choice(words) for _ in range(choose.randint(0, 12))) for _ in range(400)]
    found, features, counts = resampling.buckets_of([t.encode() for t in texts])
    ends = np.cumsum(features)
    for text, end, size, n in zip(texts, ends, features, counts):
        words_, buckets = plain_buckets(text)
        assert n == words_
        assert Counter(found[end - size : end].tolist()) == Counter(buckets)


def test_documents_are_drawn_as_worded(spark, scratch, docs, prose):
    choose = random.Random(6)
    texts = [(i * 7 % 401, " ".join(prose(choose.randint(0, 60)))) for i in range(400)]
    texts += [(9000, None), (9001, ""), (None, " ".join(prose(40))), (None, None), (9002, "one")]
    texts += [(5, texts[0][1])] * 3 + [(77_000_000_000, texts[3][1]), (-4, texts[4][1])]
    target = [" ".join(prose(50)) for _ in range(5)] + [None, ""] + [texts[9][1]] * 2
    frame = spark.createDataFrame([(*t, "r", 1) for t in texts], "doc_id long, text string, rank string, place int").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(frame, wanted, scratch)
    expected = plain(texts, target)
    assert _rows(found) == sorted(expected, key=repr)
    assert sum(r[4] is not None for r in expected) == 5 * sum(plain_buckets(t)[0] >= 20 for _, t in texts) // 100 > 10


def test_empty_tables(spark, scratch, docs):
    nothing = docs([])
    assert resampling.resample(nothing, nothing, scratch).count() == 0
    some = docs([(1, "a b"), (2, None)])
    from cohortgram.plans.storage import Scratch

    assert _rows(resampling.resample(some, nothing, Scratch(spark))) == sorted(plain([(1, "a b"), (2, None)], []), key=repr)


def test_places_are_those_of_a_sort(spark, scratch):
    """With ties, one key that holds a third of all rows, negative numbers, and the whole range of longs."""
    choose = random.Random(8)
    values = [choose.choice([0, 7, -3, choose.randint(-(2**63), 2**63 - 1), choose.randint(0, 5000)]) for _ in range(4000)]
    values += [123] * 2000
    data = [(a, choose.choice([5, 6, 7, 40_000]), i) for i, a in enumerate(values)]
    frame = spark.createDataFrame(data, "a long, b long, i long").withColumn("low", unsigned(F.col("a")))
    found = places(scratch.keep("in", frame), ["low", "b"], scratch, "out").select("a", "b", "i", "place").collect()
    assert sorted(r.i for r in found) == list(range(len(data)))
    assert [r.place for r in sorted(found, key=lambda r: r.place)] == list(range(len(data)))
    assert [(r.b, r.a) for r in sorted(found, key=lambda r: r.place)] == sorted((b, a) for a, b, _ in data)


def test_equal_rows_get_places_too(spark, scratch):
    frame = scratch.keep("same", spark.range(50).select(F.lit(3).cast("long").alias("k")))
    assert sorted(r.place for r in places(frame, ["k"], scratch, "equal").collect()) == list(range(50))


def test_whole_table(spark):
    from cohortgram.llm.registry import op13_resampling

    sf_dir = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert _rows(op13_resampling(spark, sf_dir)) == sorted(plain(texts, target), key=repr)
