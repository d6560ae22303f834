"""Exact top-k search by inner product: tiled matrix products and a tree of merges.

Vectors are turned into integers, dealt into blocks of ``BLOCK`` rows by hash and stored as packed matrices of the narrowest
type that holds them. The work is the grid of query blocks and strips of ``FAN`` vector blocks: a task takes a query block with a
strip, multiplies it with one block after the other, selects the k best of each query in each tile and merges them, so a query leaves one
list per strip. The lists of a query are then merged ``FAN`` at a time until one is left, so no task gets more than
``FAN * k`` rows of a query. A query block is sent once per strip, a vector block once per query block.

Products are taken in doubles, which are exact below 2**53; a tile that could exceed that uses Python's integers
and saturates at the bounds of long. Ties go to the smaller ``vec_id``. Rows with a null id, and vectors that are
null or hold a null or non-finite component, take no part. Vectors of different lengths are not compared; an empty vector scores
0 against another. Rows with a query's id are its own and no candidates of it; of repeated query ids the
smallest vector is the query, repeated candidates count each time. No rows give no rows. Columns besides
``vec_id`` and ``embedding`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.plans.storage import Scratch

#: Rows of a block: the score matrix of a tile takes 8 * BLOCK * BLOCK bytes.
BLOCK = 2048
#: Lists merged at a time.
FAN = 16

_EXACT = 2.0**53
_LONG = 2**63
_BLOCK = "block long, width long, ids binary, kind string, matrix binary"
_LISTS = "query_id long, node long, score long, vec_id long"


def whole_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """``vec_id, vector`` with ``floor(scale * x)`` of each component; rows with an id and finite numbers only."""
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: _floor(F.lit(scale) * x))
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~broken
    )


def _floor(x: Column) -> Column:
    """Floor that stays a double, whatever the size."""
    whole = F.rint(x)
    return F.when(whole > x, whole - 1).otherwise(whole)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """``block, width, ids, kind, matrix``: packed rows of equal width; a block is one row per width it holds."""
    count = -(-max(1, rows.count()) // size)
    # The id of the row within the stored table spreads repeated vectors too.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)))

    def pack(group: pa.Table) -> pa.Table:
        by_width: dict[int, list] = {}
        for vec_id, vector in zip(group.column("vec_id").to_pylist(), group.column("vector").to_pylist()):
            by_width.setdefault(len(vector), []).append((vec_id, vector))
        out = []
        for width, members in by_width.items():
            members.sort()
            matrix = _narrowest(np.array([v for _, v in members], "<f8").reshape(len(members), width))
            ids = np.array([i for i, _ in members], "<i8")
            out.append((group.column("block")[0].as_py(), width, ids.tobytes(), matrix.dtype.str, matrix.tobytes()))
        return pa.table([pa.array(c) for c in zip(*out)], names=["block", "width", "ids", "kind", "matrix"])

    return dealt.groupBy("block").applyInArrow(pack, _BLOCK)


def best_of_tile(queries: np.ndarray, query_ids, vectors: np.ndarray, vec_ids, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query in a tile as (row of the query, score, vec_id); ``vec_ids`` ascend."""
    bound = np.abs(queries).sum(axis=1, initial=0).max(initial=0) * np.abs(vectors).max(initial=0)
    if not bound * len(vec_ids) * 2 < _EXACT:
        out = []
        for i, query in enumerate(queries):
            own = [int(x) for x in query]
            scores = [max(1 - _LONG, min(_LONG - 1, sum(a * int(b) for a, b in zip(own, v)))) for v in vectors]
            ranked = sorted((-s, c) for s, c in zip(scores, vec_ids.tolist()) if c != query_ids[i])[:k]
            out += [(i, -s, c) for s, c in ranked]
        return tuple(np.array([r[c] for r in out], np.int64) for c in range(3))
    # Score and place in one number: equal scores rank by place, which follows the id.
    count = len(vec_ids)
    keyed = (queries @ vectors.T) * count - np.arange(count)
    keyed[query_ids[:, None] == vec_ids[None, :]] = -np.inf
    if k < count:
        kept = np.argpartition(keyed, count - k, axis=1)[:, count - k :]
    else:
        kept = np.broadcast_to(np.arange(count), keyed.shape)
    values = np.take_along_axis(keyed, kept, axis=1)
    row, column = np.nonzero(values != -np.inf)
    place = kept[row, column]
    # A whole multiple of the count, so the division is exact.
    score = ((values[row, column] + place) / count).astype(np.int64)
    return row, score, vec_ids[place]


def merged(lists: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query of several lists."""
    row, score, vec_id = (np.concatenate(c) for c in zip(*lists))
    order = np.lexsort((vec_id, -score, row))
    row = row[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    order = order[rank < k]
    return row[rank < k], score[order], vec_id[order]


def _narrowest(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    for kind in ("<i1", "<i2", "<i4"):
        limits = np.iinfo(kind)
        if limits.min <= matrix.min(initial=0) and matrix.max(initial=0) <= limits.max:
            return matrix.astype(kind)
    return matrix


def _matrix(block: dict) -> np.ndarray:
    """The packed rows of a block, as doubles; products of those are the fast ones."""
    rows = len(block["ids"]) // 8
    return np.frombuffer(block["matrix"], block["kind"]).reshape(rows, block["width"]).astype("<f8")


def search(rows: DataFrame, is_query: Column, k: int, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``. ``rows`` holds ``vec_id`` and ``vector`` of whole numbers."""
    stored = scratch.keep("vectors", rows)
    queries = stored.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    right = scratch.keep("blocks", blocks(stored, block))
    left = scratch.keep("query_blocks", blocks(scratch.keep("queries", queries), block))
    n_left, n_right = (f.agg(F.max("block")).first()[0] for f in (left, right))
    if n_left is None:
        return stored.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    n_strips = n_right // FAN + 1
    packed = ("width", "ids", "kind", "matrix")
    strip = F.floor(F.col("block") / FAN)

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    queried = left.select(F.col("block").alias("q"), numbers(n_strips).alias("strip"), F.lit(-1).cast("long").alias("v"), *packed)
    searched = right.select(numbers(n_left + 1).alias("q"), strip.alias("strip"), F.col("block").alias("v"), *packed)

    def best(group: pa.Table) -> pa.Table:
        # One query block of a width and at most FAN vector blocks; either may be missing.
        found = sorted(range(group.num_rows), key=lambda i: group.column("v")[i].as_py())
        kept, query_ids, node = None, np.empty(0, np.int64), 0
        for i in found:
            block = group.slice(i, 1).to_pylist()[0]
            ids, matrix = np.frombuffer(block["ids"], "<i8"), _matrix(block)
            if block["v"] < 0:
                query_ids, queries, node = ids, matrix, block["strip"]
            elif not len(query_ids):
                break
            else:
                tile = best_of_tile(queries, query_ids, matrix, ids, k)
                kept = tile if kept is None else merged([kept, tile], k)
        row, score, vec_id = kept or [np.empty(0, np.int64)] * 3
        columns = [query_ids[row], np.full(len(row), node, np.int64), score, vec_id]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in _LISTS.split(", ")])

    lists = queried.unionByName(searched).groupBy("q", "strip", "width").applyInArrow(best, _LISTS)
    order = F.struct((-F.col("score")).alias("less"), "vec_id", "score")
    nodes = n_strips
    while True:
        # At most FAN * k rows of a query meet in a group.
        nodes = -(-nodes // FAN)
        lists = lists.groupBy("query_id", F.floor(F.col("node") / FAN).alias("node")).agg(
            F.slice(F.sort_array(F.collect_list(order)), 1, k).alias("best")
        )
        if nodes == 1:
            ranked = lists.select("query_id", F.posexplode("best").alias("place", "hit"))
            return ranked.select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.score")
        lists = lists.select("query_id", "node", F.explode("best").alias("hit")).select("query_id", "node", "hit.vec_id", "hit.score")
