"""MinHash near-duplicates with tensored banding.

A document's set holds its distinct word shingles. Two collections of ``GROUPS`` groups of ``WIDTH`` minhashes
each are made; a table's key is one group of the first collection with one of the second. So GROUPS * GROUPS
tables of 2 * WIDTH hashes cost only 2 * GROUPS * WIDTH minhashes. Two documents of similarity s share a
table unless one collection has no equal group: with 8 groups of 2, at s = 0.8, with probability 0.0006, at
0.9 below 0.000004. Every link is confirmed on the full sets.

Hot groups. Documents with the same set are one class, found by an aggregation. In a table's bucket the classes
are first compared with the bucket's leader only, which settles groups of near copies with one pair a member.
Buckets whose members still lie in several components get another leader each round, as long as a good part of
these pairs are links. What then still shares a bucket across components is compared in tiles: classes that share
leaders form blocks of bounded size, two blocks with a bucket in common form a tile, and a task finds the
sizes of all intersections of a tile by matrix products and puts out no more links than join its components. So no
pairs are made, every pair that shares a bucket is compared, and pairs inside a component, which cannot
change the result, are not looked at. Classes most of whose shingles no other open class has are left out first: with fewer
than 80 % of its shingles to share a set is near to none.

A null or empty text, or one without words, has an empty set and no links. Rows with a null ``doc_id`` take part; a component of
such rows alone has a null id. Repeated rows get the same component. No rows give no rows. Columns besides
``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgram.llm import memory
from cohortgram.llm.components import components
from cohortgram.llm.text import WORDS, alnum_words, free_name, mixed, parts, shingle_hashes, spaced_words, texts_of
from cohortgram.plans.storage import Scratch

GROUPS = 8
WIDTH = 2
#: Share of links among the pairs of a round below which new leaders no longer pay.
WORTHWHILE = 0.1
#: Shingles and classes of a block, about.
BLOCK_SHINGLES, BLOCK_CLASSES = 50_000, 256
#: Columns of a matrix product.
_COLUMNS = 4096

_SEEDS = np.random.default_rng(1).integers(1, 2**63, 2 * GROUPS * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SIGNED = "doc_id long, version long, n_shingles long, set_key binary, minhashes binary"
_SETS = "set_key binary, members binary"
_BUCKETS = "bucket long, class long, n long"


def shingle_set(text: bytes, size: int, letters_only: bool = False) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = alnum_words(text) if letters_only else spaced_words(text)
    return np.unique(shingle_hashes(WORDS.of(words), size))


def minhashes(members: np.ndarray) -> np.ndarray:
    """One minimum per seed, as unsigned 32-bit."""
    return np.array([((members ^ s) * s >> np.uint64(32)).min() for s in _SEEDS], np.uint32)


def table_keys(signature: np.ndarray) -> np.ndarray:
    """The keys of all tables: each group of the first collection with each of the second."""
    groups = signature.astype(np.uint64).reshape(2, GROUPS, WIDTH)
    hashed = np.full((2, GROUPS), np.uint64(1))
    for i in range(WIDTH):
        hashed = mixed(hashed ^ groups[:, :, i])
    tables = np.arange(GROUPS * GROUPS, dtype=np.uint64).reshape(GROUPS, GROUPS)
    keys = mixed(hashed[0][:, None] * np.uint64(0x9E3779B97F4A7C15) + hashed[1][None, :])
    return mixed(keys ^ tables).ravel().view(np.int64)


def _sign(size: int, letters_only: bool):
    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("near_dedup")
        for batch in parts(rows):
            counts, keys, signatures = [], [], []
            for text in texts_of(batch.column("text")):
                members = shingle_set(text, size, letters_only)
                counts.append(len(members))
                keys.append(xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None)
                signatures.append(minhashes(members).tobytes() if len(members) else None)
            made = [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())]
            names = ["doc_id", "version", "n_shingles", "set_key", "minhashes"]
            yield pa.record_batch([batch.column("doc_id"), batch.column("version"), *made], names=names)

    return sign


def _full_sets(size: int, letters_only: bool):
    def full(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("near_dedup")
        for batch in parts(rows):
            sets = [shingle_set(t, size, letters_only).tobytes() for t in texts_of(batch.column("text"))]
            keys = [xxhash.xxh3_128_digest(s) for s in sets]
            yield pa.record_batch([pa.array(c, pa.binary()) for c in (keys, sets)], names=["set_key", "members"])

    return full


def _bucket(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = GROUPS * GROUPS
    for part in parts(rows):
        keys = [table_keys(np.frombuffer(s, np.uint32)) for s in part.column("minhashes").to_pylist()]
        place = pa.array(np.repeat(np.arange(part.num_rows), tables))
        columns = [pa.array(np.concatenate(keys)), *(part.column(c).take(place) for c in ("class", "n"))]
        yield pa.record_batch(columns, names=["bucket", "class", "n"])


def _confirm(percent: int):
    def confirm(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(rows):
            kept = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                merged = np.concatenate([a, b])
                merged.sort()
                common = int((merged[1:] == merged[:-1]).sum())
                kept.append(100 * common >= percent * (len(merged) - common))
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept))

    return confirm


def _exploded(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(rows):
        sets = [np.frombuffer(m, np.int64) for m in part.column("members").to_pylist()]
        owner = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
        yield pa.record_batch([pa.array(np.concatenate(sets)), part.column("class").take(owner)], names=["shingle", "class"])


def common_sizes(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of one list with each of the other."""
    everything = np.concatenate([*left, *right])
    values, column, count = np.unique(everything, return_inverse=True, return_counts=True)
    # A value of one set alone is in no intersection.
    several = count > 1
    place = np.cumsum(several) - 1
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    kept = several[column]
    row, column = row[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    sizes = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(several.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        holds = np.zeros((len(left) + len(right), _COLUMNS), np.float32)
        holds[row[a:b], column[a:b] - start] = 1
        sizes += holds[: len(left)] @ holds[len(left) :].T
    return sizes.astype(np.int64)


def _pack(group: pa.Table) -> pa.Table:
    members = group.column("members").to_pylist()
    packed = [
        np.array(group.column("class").to_pylist(), np.int64).tobytes(),
        np.array(group.column("component").to_pylist(), np.int64).tobytes(),
        np.array([len(m) // 8 for m in members], np.int64).tobytes(),
        b"".join(members),
    ]
    columns = [pa.array([group.column("block")[0].as_py()]), *(pa.array([p], pa.binary()) for p in packed)]
    return pa.table(columns, names=["block", "classes", "components", "sizes", "members"])


_PACKED = "block long, classes binary, components binary, sizes binary, members binary"


def _unpacked(row: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    classes, found, sizes = (np.frombuffer(row[prefix + c], np.int64) for c in ("classes", "components", "sizes"))
    return classes, found, np.split(np.frombuffer(row[prefix + "members"], np.uint64), np.cumsum(sizes)[:-1])


def _compare_blocks(percent: int):
    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("near_dedup")
        for row in (r for one in parts(rows, 1) for r in one.to_pylist()):
            a, a_component, a_sets = _unpacked(row, "a_")
            b, b_component, b_sets = _unpacked(row, "b_")
            common = common_sizes(a_sets, b_sets)
            total = np.array([len(s) for s in a_sets])[:, None] + np.array([len(s) for s in b_sets])[None, :]
            near = (100 * common >= percent * (total - common)) & (a_component[:, None] != b_component[None, :])
            found, joined = [], {}

            def root(x: int) -> int:
                while joined.get(x, x) != x:
                    x = joined[x]
                return x

            for i, j in zip(*np.nonzero(near)):
                x, y = root(int(a_component[i])), root(int(b_component[j]))
                if x != y:
                    joined[max(x, y)] = min(x, y)
                    found.append((int(a[i]), int(b[j])))
            yield pa.record_batch([pa.array([f[c] for f in found], pa.int64()) for c in range(2)], names=["a", "b"])

    return compare


def _near_in_size(percent: int) -> Column:
    return 100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n")


class _Search:
    """The classes of a document table and their confirmed links, found step by step."""

    def __init__(self, docs: DataFrame, scratch: Scratch, size: int, percent: int, letters_only: bool):
        self.scratch, self.percent, self.turn = scratch, percent, 0
        docs = docs.select(F.col("doc_id").cast("long"), "text")
        versioned = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
        self.signed = scratch.keep("signed", versioned.mapInArrow(_sign(size, letters_only), _SIGNED))
        classes = self.signed.where("set_key IS NOT NULL").groupBy("set_key").agg(
            F.min("doc_id").alias("first_doc"), F.max("n_shingles").alias("n"), F.first("minhashes").alias("minhashes")
        )
        self.classes = scratch.keep("classes", classes.withColumn("class", F.monotonically_increasing_id()))
        buckets = self.classes.select("minhashes", "class", "n").mapInArrow(_bucket, _BUCKETS)
        shared = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
        self.buckets = scratch.keep("buckets", buckets.join(shared, "bucket"))
        # No relation of pairs, links or members below has more rows.
        self.rows = max(self.buckets.count(), self.classes.count())
        # Full sets of those classes alone, made again from the text of their first document.
        wanted = self.classes.join(self.buckets.select("class").distinct(), "class", "left_semi")
        first = wanted.select("first_doc").distinct()
        texts = docs.join(first, docs["doc_id"].eqNullSafe(first["first_doc"]), "left_semi").select("text")
        sets = texts.mapInArrow(_full_sets(size, letters_only), _SETS)
        known = wanted.select("set_key", "class").join(sets, "set_key").groupBy("class").agg(F.first("members").alias("members"))
        self.sets = scratch.keep("sets", known)
        self.components = self.classes.select(F.col("class").alias("vertex"), F.col("class").alias("component")).limit(0)

    def confirm(self, pairs: DataFrame) -> float:
        """Takes up the pairs ``a, b`` whose sets are near; the share of them that are."""
        self.turn += 1
        pairs = self.scratch.keep(f"pairs_{self.turn}", pairs, self.rows)
        left = self.sets.select(F.col("class").alias("a"), F.col("members").alias("left"))
        right = self.sets.select(F.col("class").alias("b"), F.col("members").alias("right"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        new = self.scratch.keep(f"links_{self.turn}", both.mapInArrow(_confirm(self.percent), "a long, b long"), self.rows)
        found, looked = new.count(), pairs.count()
        if found:
            self._take_up(new)
        return found / max(1, looked)

    def _take_up(self, links: DataFrame) -> None:
        # The stars found so far stand for the links they came from.
        stars = self.components.where("vertex <> component").toDF("a", "b")
        self.components = components(stars.union(links), self.scratch, f"stars_{self.turn}", 2 * self.rows)

    def open_members(self) -> DataFrame:
        """``bucket, class, n, component`` of the buckets that hold several components."""
        labels = self.components.select(F.col("vertex").alias("class"), "component")
        members = self.buckets.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
        spread = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        found = members.join(spread.where("x < y").select("bucket"), "bucket")
        return self.scratch.keep(f"open_{self.turn}", found.select("bucket", "class", "n", "component"), self.rows)

    def against_leaders(self, members: DataFrame) -> DataFrame:
        """Every member with one of its bucket that another order picks each time."""
        order = F.struct(F.xxhash64("class", F.lit(self.turn)), "class", "n", "component")
        leaders = members.groupBy("bucket").agg(F.min(order).alias("leader")).select(
            "bucket", F.col("leader.class").alias("b"), F.col("leader.n").alias("other_n"), F.col("leader.component").alias("other")
        )
        pairs = members.join(leaders, "bucket").where((F.col("component") != F.col("other")) & _near_in_size(self.percent))
        return pairs.select(F.col("class").alias("a"), "b").distinct()

    def in_tiles(self, members: DataFrame) -> None:
        """Compares all classes that share a bucket and lie in different components."""
        shingles = self.sets.join(members.select("class").distinct(), "class").mapInArrow(_exploded, "shingle long, class long")
        alone = shingles.groupBy("shingle").agg(F.min("class").alias("class"), F.max("class").alias("last")).where("class = last")
        own = alone.groupBy("class").agg(F.count("*").alias("alone"))
        shared = F.col("n") - F.coalesce("alone", F.lit(0))
        open_ = members.join(own, "class", "left").where(100 * shared >= self.percent * F.col("n")).drop("alone")
        open_ = self.scratch.keep("may_be_near", open_, self.rows)

        leaders = open_.groupBy("bucket").agg(F.min("class").alias("leader"))
        classes = open_.join(leaders, "bucket").groupBy("class", "n", "component").agg(F.min("leader").alias("family"))
        parts = F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_CLASSES))
        families = classes.groupBy("family").agg(parts.alias("parts"))
        block = F.xxhash64("family", F.pmod(F.xxhash64("class"), "parts"))
        placed = classes.join(families, "family").withColumn("block", block).select("class", "component", "block")
        placed = self.scratch.keep("placed", placed, self.rows)
        packed = placed.join(self.sets, "class").groupBy("block").applyInArrow(_pack, _PACKED)
        packed = self.scratch.keep("packed", packed)

        met = open_.select("bucket", "class").join(placed, "class").groupBy("bucket", "block").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        other = met.toDF("bucket", "other", "other_low", "other_high")
        apart = (F.col("block") <= F.col("other")) & (F.least("low", "other_low") < F.greatest("high", "other_high"))
        tiles = met.join(other, "bucket").where(apart).select(F.col("block").alias("a_block"), F.col("other").alias("b_block")).distinct()
        for side in "ab":
            tiles = tiles.join(packed.select([F.col(c).alias(f"{side}_{c}") for c in packed.columns]), f"{side}_block")
        self.turn += 1
        links = tiles.drop("a_block", "b_block").mapInArrow(_compare_blocks(self.percent), "a long, b long")
        self._take_up(self.scratch.keep(f"links_{self.turn}", links, self.rows))

    def run(self) -> None:
        members = self.buckets.withColumn("component", F.col("class"))
        found = 1.0
        while found >= WORTHWHILE:
            found = self.confirm(self.against_leaders(members))
            members = self.open_members()
        if not members.isEmpty():
            self.in_tiles(members)


def near_duplicates(
    docs: DataFrame, scratch: Scratch, size: int = 5, percent: int = 80, letters_only: bool = False
) -> DataFrame:
    """``doc_id, version, n_shingles, component, component_id, kept`` per row.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at least ``percent`` / 100; ``kept`` says
    whether it is the row's own. ``version`` is a hash of the text, ``component`` a number without meaning, null for
    an empty set.
    """
    search = _Search(docs, scratch, size, percent, letters_only)
    search.run()
    labels = search.components.select(F.col("vertex").alias("class"), "component")
    linked = search.classes.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = linked.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    known = scratch.keep("known", linked.join(smallest, "component").select("set_key", "component", "component_id"), search.rows)
    alone = F.col("set_key").isNull()
    return search.signed.join(known, "set_key", "left").select(
        "doc_id",
        "version",
        "n_shingles",
        "component",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def without_copies(docs: DataFrame, scratch: Scratch, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, the one of smallest ``doc_id``, and every row with an empty set.

    Of rows with equal ``doc_id`` and text one stays; of several texts under the smallest id, that of smallest hash.
    """
    found = near_duplicates(docs, scratch, size, percent, letters_only=True).where("kept")
    one = found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "version")).alias("row"))
    rows = one.select("row.*").union(found.where("component IS NULL").select("doc_id", "version").distinct())
    id_, version, place = (free_name(docs.columns, n) for n in ("_id", "_version", "_place"))
    key = [F.coalesce("doc_id", F.lit(0).cast("long")).alias(id_), F.xxhash64("version", F.col("doc_id").isNull()).alias(version)]
    kept = scratch.keep("kept", rows.select(*key))
    # Repeated rows are limited to one in each task before the shuffle, which also serves the join.
    keyed = docs.withColumn(id_, F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))).withColumn(
        version, F.xxhash64(F.xxhash64("text"), F.col("doc_id").isNull())
    )
    single = Window.partitionBy(id_, version).orderBy(version)
    distinct = keyed.withColumn(place, F.row_number().over(single)).where(F.col(place) == 1).drop(place)
    return distinct.join(kept, [id_, version], "left_semi").select(*docs.columns)
