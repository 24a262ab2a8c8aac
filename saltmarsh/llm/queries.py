"""Queries of the training-data operators over the whole tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, ship_package
from .exact import exact_groups
from .media import media_column, media_digest
from .mixing import MAX_REPEATS, SEED, WORD, mix_counts
from .near import near_groups
from .passages import passage_links
from .quality import THRESHOLD as QUALITY_THRESHOLD
from .quality import fit_quality, with_quality
from .spiece import with_pieces
from .tokenfile import token_digest
from .toxicity import THRESHOLD as TOXICITY_THRESHOLD
from .toxicity import fit_toxicity, with_toxicity
from .warc import warc_digest


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document contributes to the mix of all sources."""
    docs = _table(spark, sf_dir, "documents")
    counted = mix_counts(docs, keep=("doc_id", "source"))
    return counted.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP1_SQL = f"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT source, source_size, {MAX_REPEATS} * source_size AS most, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS HUGEINT) AS weight FROM per),
running AS (SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
    sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM weighted),
stops AS (SELECT *, CAST(most AS HUGEINT) * CAST(weights AS HUGEINT) < weight * CAST(total - stopped AS HUGEINT) AS stops FROM running),
levels AS (SELECT *, total - sum(CASE WHEN stops THEN most ELSE 0 END) OVER () AS rest, sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () AS free FROM stops),
targets AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, CASE WHEN stops THEN CAST(most AS DOUBLE) ELSE CAST(weight * CAST(rest AS HUGEINT) AS DOUBLE) / CAST(free AS DOUBLE) END AS target FROM levels),
rates AS (SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rates
"""


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as Matroska samples and read back."""
    return media_digest(media_column(_table(spark, sf_dir, "documents")))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and what they decode to."""
    import public_tokenizers

    return with_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    scored = with_quality(docs, model, keep=("doc_id",))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc_digest(_table(spark, sf_dir, "pages"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more that documents share."""
    return passage_links(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the one kept of those with its text."""
    groups = exact_groups(_table(spark, sf_dir, "documents"), hash_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = """
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM hashed WINDOW w AS (PARTITION BY text_sha256)
"""


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its near-duplicate class."""
    groups = near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "class_id", "class_size", "n_links", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = with_toxicity(docs, model, keep=("doc_id",))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXICITY_THRESHOLD).cast("int").alias("predicted"))


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids written as Simple-8b files and read back."""
    import public_tokenizers

    return token_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_media": op2_media,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_passages": op6_passages,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_token_file": op10_token_file,
}
ORACLE_SQL: dict[str, str] = {"op1_mix_sources": OP1_SQL, "op7_exact_dedup": OP7_SQL}
