"""Connected components of a graph given as an edge table.

Every round has two steps: each vertex hands its larger neighbours to its smallest, then its smaller ones. The
edge set turns into stars whose centres are the smallest vertices, in a number of rounds that grows with the
logarithm of the longest path. Neighbours are never gathered in lists, so a vertex may have any number of them.
Each round is written to the shared folder, which keeps the lineage short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.plans.storage import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, scratch: Scratch, name: str, rows: int | None = None) -> DataFrame:
    """``vertex, component`` for every end of an edge (``a, b``, longs): the smallest vertex reachable.

    ``rows`` is an upper bound on the edges, if one is known.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = scratch.keep(f"{name}_0", edges, rows)
    state, turn = _state(edges), 0
    # A round makes at most one edge of each.
    rows = state[0]
    while True:
        turn += 1
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        centre = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(centre, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        onto = smaller.union(centre.toDF("a", "b")).where("a <> b").distinct()
        edges = scratch.keep(f"{name}_{turn}", onto, rows)
        before, state = state, _state(edges)
        if state == before:
            break
    ends = edges.toDF("vertex", "component")
    return ends.union(edges.select("b", "b").distinct()).distinct()
