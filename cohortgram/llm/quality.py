"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. A passage is encoded from its bytes: shares of character
classes and of pairs of them, word length, share of words that repeat the word before, share of distinct
words. A layer turns that into a hidden vector; gated attention, learned from document labels alone, weighs the passages
of a document; the weighted sum of hidden vectors is scored. So one spoiled passage may decide, and long texts are
scored whole.

Training takes at most ``SAMPLE`` labelled rows, those of smallest id hash, and of these, in that order, those that fit into
``BUDGET`` passages; both are bounds on what the driver gets. A chosen row has all its passages; one that does not fit any more is left out
whole. Scoring is one pass over all rows and
passages, without a shuffle. The seed is fixed, so equal input gives equal scores.

Only ``text`` enters a score. A null text is empty; a text without words is a bag of one average
passage. Labels that are null, and
labelled ids without a row, are not used; a label above 0 counts as 1. Without labels of both kinds every score is the
share of label 1, smoothed. Rows are returned one for one, repeated rows with equal scores; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm import memory
from cohortgram.llm.text import free_name, parts, sliced, texts_of

PASSAGE = 64
SAMPLE = 3000
#: Passages of all training rows together: 640 bytes each on the driver.
BUDGET = 48_000
#: Scores from here on count as label 1.
CUT = 0.3
#: One in so many ids is held out from training.
FOLDS = 5

HIDDEN, GATE, EPOCHS, RATE, DECAY = 24, 12, 50, 0.01, 1e-3

_CLASSES = 12
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []
#: Bytes of a text whose powers a worker keeps, 16 bytes each.
KEPT_POWERS = 1 << 19
#: Bytes of text scored at once.
SLICE = 1 << 20
memory.kept(_POWERS.clear)


def _class_of(byte: int) -> int:
    char = chr(byte)
    if byte >= 0x80:
        return 0
    if char.islower():
        return 1
    if char.isupper():
        return 2
    if char.isdigit():
        return 3
    if char in " \t\r":
        return 4
    if char == "\n":
        return 5
    for number, group in enumerate((".", ",;:", "!?", "'\"-()", "|"), 6):
        if char in group:
            return number
    return 11


_CLASS = np.array([_class_of(b) for b in range(256)], np.uint8)
_SPACE = np.array([b in b" \t\n\r\x0b\x0c" for b in range(256)])
FEATURES = _CLASSES + _CLASSES * _CLASSES + 4


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse; those for texts of usual length are kept."""
    if n > KEPT_POWERS:
        return _made_powers(n)
    if not _POWERS:
        _POWERS[:] = _made_powers(KEPT_POWERS)
    return _POWERS[0][:n], _POWERS[1]


def _made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.full(n, b, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def passages(text: bytes) -> np.ndarray:
    """One row of features per passage."""
    raw = np.frombuffer(text, np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(raw) else np.empty(0, np.int64)
    if not len(starts):
        return np.full((1, FEATURES), np.nan, np.float32)
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    powers, back = _powers(len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * powers, dtype=np.uint64)])
    words = (sums[ends] - sums[starts]) * back[starts]

    count = -(-len(starts) // PASSAGE)
    passage = np.repeat(np.arange(count), PASSAGE)[: len(starts)]
    per_words = np.bincount(passage, minlength=count)
    heads = starts[::PASSAGE]
    kinds = _CLASS[raw].astype(np.int64)
    owner = np.zeros(len(raw), np.int64)
    owner[heads[1:]] = 1
    owner = np.cumsum(owner)
    sizes = np.bincount(owner, minlength=count).astype(np.float32)
    single = np.bincount(owner * _CLASSES + kinds, minlength=count * _CLASSES).reshape(count, -1)
    pairs = owner[1:] * _CLASSES**2 + kinds[:-1] * _CLASSES + kinds[1:]
    double = np.bincount(pairs, minlength=count * _CLASSES**2).reshape(count, -1)

    repeats = np.bincount(passage[1:], weights=words[1:] == words[:-1], minlength=count) / per_words
    order = np.lexsort((words, passage))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order], weights=new, minlength=count) / per_words
    length = np.bincount(passage, weights=ends - starts, minlength=count) / per_words / 10
    shape = np.stack([repeats, distinct, length, np.log1p(per_words) / 5], axis=1)
    return np.concatenate([single / sizes[:, None], double / sizes[:, None], shape], axis=1).astype(np.float32)


class AttentionModel:
    """Hidden layer, gated attention and output, with the scaling of features."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int = 7):
        random = np.random.default_rng(seed)
        self.mean, self.deviation = mean, deviation
        self.weights = {
            "hidden": random.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)),
            "hidden_bias": np.zeros(HIDDEN),
            "value": random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
            "gate": random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
            "attention": random.normal(0, 1 / np.sqrt(GATE), GATE),
            "output": random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            "bias": np.zeros(1),
        }

    def forward(self, x: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        """``bag`` has the first passage of each document."""
        w, out = self.weights, {}
        out["x"] = np.nan_to_num(np.clip((x - self.mean) / self.deviation, -8, 8))
        out["h"] = np.tanh(out["x"] @ w["hidden"] + w["hidden_bias"])
        out["v"] = np.tanh(out["h"] @ w["value"])
        out["g"] = 1 / (1 + np.exp(-(out["h"] @ w["gate"])))
        logits = (out["v"] * out["g"]) @ w["attention"]
        sizes = np.diff(np.append(bag, len(x)))
        raised = np.exp(logits - np.repeat(np.maximum.reduceat(logits, bag), sizes))
        out["a"] = raised / np.repeat(np.add.reduceat(raised, bag), sizes)
        out["z"] = np.add.reduceat(out["a"][:, None] * out["h"], bag)
        out["p"] = 1 / (1 + np.exp(-np.clip(out["z"] @ w["output"] + w["bias"], -30, 30)))
        out["sizes"] = sizes
        return out

    def gradients(self, x: np.ndarray, bag: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, o = self.weights, self.forward(x, bag)
        error = (o["p"] - labels) / len(labels)
        of_z = np.repeat(error[:, None] * w["output"], o["sizes"], axis=0)
        of_a = (of_z * o["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(o["a"] * of_a, bag), o["sizes"])
        of_logit = o["a"] * (of_a - mean)
        of_vg = of_logit[:, None] * w["attention"]
        of_v = of_vg * o["g"] * (1 - o["v"] ** 2)
        of_g = of_vg * o["v"] * o["g"] * (1 - o["g"])
        of_h = of_z * o["a"][:, None] + of_v @ w["value"].T + of_g @ w["gate"].T
        of_h *= 1 - o["h"] ** 2
        return {
            "hidden": o["x"].T @ of_h,
            "hidden_bias": of_h.sum(axis=0),
            "value": o["h"].T @ of_v,
            "gate": o["h"].T @ of_g,
            "attention": (o["v"] * o["g"]).T @ of_logit,
            "output": o["z"].T @ error,
            "bias": error.sum(keepdims=True),
        }

    def score(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        return self.forward(x, bag)["p"]


class Constant:
    """Stands for a model where labels of both kinds are missing."""

    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        return np.full(len(bag), self.share)


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> AttentionModel | Constant:
    """Adam on batches of documents."""
    everything = np.concatenate(bags) if bags else np.empty((0, FEATURES), np.float32)
    if not len(labels) or labels.min() == labels.max() or np.isnan(everything).all():
        return Constant((labels.sum() + 1) / (len(labels) + 2))
    model = AttentionModel(np.nanmean(everything, axis=0), np.nanstd(everything, axis=0) + 1e-3, seed)
    random = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(bags))
        for i in range(0, len(order), 128):
            chosen = order[i : i + 128]
            x = np.concatenate([bags[j] for j in chosen])
            starts = np.cumsum([0, *(len(bags[j]) for j in chosen[:-1])])
            step += 1
            for name, slope in model.gradients(x, starts, labels[chosen]).items():
                if name not in ("bias", "hidden_bias"):
                    slope = slope + DECAY * model.weights[name]
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                model.weights[name] = model.weights[name] - RATE * change
    return model


def held_out(doc_id: str = "doc_id"):
    """Rows that training never sees; a null id is not held out and has no label."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> AttentionModel | Constant:
    """Fits a model to labelled rows that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where(
        F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    chosen = usable.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(chosen, "doc_id").dropDuplicates(["doc_id"])

    def measure(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(rows):
            counts = [max(1, -(-len(text.split()) // PASSAGE)) for text in texts_of(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), batch.column("place"), pa.array(counts, pa.int64())], names=["doc_id", "place", "passages"])

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(rows):
            found = [passages(text).tobytes() for text in texts_of(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), batch.column("quality"), pa.array(found, pa.binary())], names=["doc_id", "quality", "passages"])

    # At most SAMPLE rows of numbers, then at most BUDGET passages.
    placed = texts.withColumn("place", F.xxhash64("doc_id"))
    sizes = placed.mapInArrow(measure, "doc_id long, place long, passages long").collect()
    fitting, left = [], BUDGET
    for row in sorted(sizes, key=lambda r: (r["place"], r["doc_id"])):
        if row["passages"] <= left:
            fitting.append(row["doc_id"])
            left -= row["passages"]
    if len(fitting) < len(sizes):
        texts = texts.where(F.col("doc_id").isin(fitting))
    rows = sorted(texts.mapInArrow(encode, "doc_id long, quality int, passages binary").collect())
    bags = [np.frombuffer(r["passages"], np.float32).reshape(-1, FEATURES) for r in rows]
    return fit(bags, np.array([float(r["quality"] > 0) for r in rows]))


def with_scores(docs: DataFrame, model: AttentionModel | Constant, column: str) -> DataFrame:
    """The rows with the score of ``text`` in ``column``."""
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory.begin("quality")
        for array in texts:
            found = [np.empty(0)]
            for batch in sliced([pa.record_batch([array], names=["text"])], SLICE):
                bags = [passages(t) for t in texts_of(batch.column("text"))]
                starts = np.cumsum([0, *map(len, bags[:-1])])
                found.append(model.score(np.concatenate(bags), starts))
            yield pa.array(np.concatenate(found), pa.float64())
        memory.release()

    # The texts go to Python and the scores come back; the other columns stay where they are.
    return docs.withColumn(column, score("text"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row."""
    model = train(docs, labels)
    scored = with_scores(docs.select(F.col("doc_id").cast("long"), "text"), model, "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that score as label 1, all columns as they are."""
    name = free_name(docs.columns, "_score")
    return with_scores(docs, train(docs, labels), name).where(F.col(name) >= CUT).drop(name)
