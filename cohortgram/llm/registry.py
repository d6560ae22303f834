"""One query per operator over the document, page and vector tables, with SQL where SQL can say the same.

Every query applies its operator to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgram.llm import arrow_output, decontaminate, html_extract, license_scan, line_dedup, near_dedup, packing, quality, resampling, secret_scan, token_alignment, token_count, topk
from cohortgram.plans.storage import Scratch

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_SIZE = 50257
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
TOKEN_LIMIT = 1024
#: Components are multiplied by it and rounded down.
VECTOR_SCALE = 64.0
QUERY_STEP = 20
TOP = 20


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their four-word shingles."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark), size=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP1_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY 1, 2
),
links AS (
    SELECT x, y FROM common JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
    WHERE 100 * n >= 80 * (len(a.s) + len(b.s) - n)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT doc_id AS v, doc_id AS r FROM documents
    UNION
    SELECT reach.v, edges.y FROM reach JOIN edges ON edges.x = reach.r
),
smallest AS (SELECT v, min(r) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN smallest ON v = doc_id
"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license labels of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row per pair."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), Scratch(spark), tokenizer(WORD_BPE), end_id=2)


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors of every twentieth vector."""
    rows = topk.whole_vectors(table(spark, sf_dir, "embeddings"), VECTOR_SCALE)
    return topk.search(rows, F.col("vec_id") % QUERY_STEP == 0, TOP, Scratch(spark))


OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 20 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counted = token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.main_text(table(spark, sf_dir, "pages"), Scratch(spark))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_arrow_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read back from the Arrow files they were written to."""
    manifest = arrow_output.write_sequences(
        table(spark, sf_dir, "documents"), Scratch(spark), tokenizer(BYTE_BPE), end_id=0, vocabulary=BYTE_BPE_SIZE
    )
    return arrow_output.read_documents(manifest)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the blocks they share with earlier ones."""
    found = line_dedup.without_shared_blocks(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark))
    return found.select("doc_id", "n_lines", "n_deleted", F.length("text").cast("long").alias("n_chars"), "text")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned, and the counts of its linked pairs in all documents."""
    return token_alignment.align(table(spark, sf_dir, "documents"), Scratch(spark), tokenizer(BYTE_BPE), tokenizer(PIECE_BPE))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark texts, and the ranks of those drawn."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_near_dedup,
        op2_license_scan,
        op3_decontamination,
        op4_packing,
        op5_topk_search,
        op6_token_count,
        op7_quality,
        op8_html_extract,
        op9_arrow_output,
        op10_line_dedup,
        op11_secret_scan,
        op12_token_alignment,
        op13_resampling,
    )
    import corpus_pipeline

    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_near_dedup": OP1_SQL, "op5_topk_search": OP5_SQL}
