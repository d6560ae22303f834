"""From raw documents to packed training sequences.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a frame, which ``run`` writes as
Parquet to the shared folder and reads again for the next. All but the last return the columns of ``docs``.

1. quality: documents that the classifier rejects go.
2. line_dedup: blocks of 20 words or more that an earlier document holds are cut out of the text; documents
   of which nothing is left by that go.
3. near_dedup: of each group of near copies (five-word shingles, similarity 0.8) the row with the smallest
   ``doc_id`` stays; of its repeated rows one.
4. decontamination: documents that hold a benchmark item go.
5. packing: the pieces of what is left in windows of 4096 tokens, as ``op4_packing`` returns them.

Each stage lowers the session's rows per Arrow batch (``memory.small_batches``), which bounds what JVM and workers hold of texts on their way.

Empty texts pass the first four stages. Rows with a null ``doc_id`` are kept by stage 2 as they are; in stage
3 they take part, and one of a group of such rows alone stays. ``n_chars`` follows the text where it is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgram.llm import decontaminate, line_dedup, memory, near_dedup, packing, quality
from cohortgram.llm.registry import WORD_BPE, table, tokenizer
from cohortgram.llm.text import free_name
from cohortgram.plans.storage import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    memory.small_batches(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    memory.small_batches(spark)
    n_lines, n_deleted = (free_name(docs.columns, n) for n in ("_n_lines", "_n_deleted"))
    found = line_dedup.without_shared_blocks(docs, Scratch(spark), (n_lines, n_deleted))
    whole = F.col(n_deleted) == 0
    kept = found.where(whole | F.col("text").rlike(r"[^\s\p{Punct}]"))
    if "n_chars" in docs.columns:
        cut = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(cut))
    return kept.select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    memory.small_batches(spark)
    return near_dedup.without_copies(docs, Scratch(spark))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    memory.small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    memory.small_batches(spark)
    return packing.pack_documents(docs, Scratch(spark), tokenizer(WORD_BPE), end_id=2)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A trained classifier, minhashes and byte-pair merges have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents table."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(name, stage(spark, docs, sf_dir))
    return docs
