"""Relevance scores of a language model: prompts, parsing, filters, counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import present
from ..functions.values import PROMPT_ABSTRACT_CHARS, SCORE_THRESHOLD


def prompt_fields(title: str = "title", abstract: str = "abstract") -> tuple[Column, Column]:
    """Title and abstract as a prompt shows them: placeholders for what is missing, long abstracts cut."""
    a = F.col(abstract)
    cut = F.when(F.length(a) > PROMPT_ABSTRACT_CHARS, F.concat(F.substring(a, 1, PROMPT_ABSTRACT_CHARS), F.lit("…"))).otherwise(a)
    return F.coalesce(present(title), F.lit("(no title)")), F.coalesce(present(cut), F.lit("(no abstract available — score based on title only)"))


def with_prompt(papers: DataFrame, template: str, column: str = "prompt") -> DataFrame:
    """`template` with {title} and {abstract} filled in."""
    title, abstract = prompt_fields()
    parts: list[Column] = []
    for i, piece in enumerate(template.split("{title}")):
        parts += [title] if i else []
        for j, rest in enumerate(piece.split("{abstract}")):
            parts += ([abstract] if j else []) + [F.lit(rest)]
    return papers.withColumn(column, F.concat(*parts))


def with_answers(papers: DataFrame, backend: Callable[[list[str]], list[str | None]], prompt: str = "prompt", column: str = "answer") -> DataFrame:
    """The answers of a backend (prompts to answers, None on failure) beside the papers."""
    schema = StructType([*papers.schema.fields, StructField(column, StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{column: backend(batch[prompt].tolist())})

    return papers.mapInPandas(run, schema)


def parsed_score(answer: str = "answer") -> tuple[Column, Column]:
    """Score (0 to 10) and reason of an answer (N01): of the first flat JSON object, else the first number of one or two digits if it is at most ten."""
    text = F.trim(F.coalesce(F.col(answer), F.lit("")))
    found = F.regexp_extract(text, r"(\{[^{}]*\})", 1)
    own = F.try_parse_json(F.nullif(found, F.lit("")))
    raw = F.try_variant_get(own, "$.score", "string")
    number = raw.try_cast("double")
    score = F.when(number.between(-1e9, 1e9), F.least(F.lit(10), F.greatest(F.lit(0), number.cast("int"))))
    bare = F.regexp_extract(text, r"\b(\d{1,2})\b", 1).try_cast("int")
    bare = F.when(bare <= 10, bare)
    reason = F.when(score.isNotNull(), F.coalesce(F.try_variant_get(own, "$.reason", "string"), F.lit(""))).when(bare.isNotNull(), F.substring(text, 1, 200)).otherwise("")
    return F.coalesce(score, bare), reason


def with_scores(papers: DataFrame, answer: str = "answer", abstract: str = "abstract") -> DataFrame:
    """relevance_score, relevance_reason, score_confidence."""
    score, reason = parsed_score(answer)
    confidence = F.when(F.coalesce(F.col(abstract), F.lit("")) != "", "high").otherwise("low")
    return papers.withColumns({"relevance_score": score, "relevance_reason": reason, "score_confidence": confidence})


def at_least(papers: DataFrame, threshold: int | None = None, score: str = "relevance_score") -> DataFrame:
    """Papers of a score no less than the threshold; no score never passes."""
    return papers.filter(F.col(score) >= (SCORE_THRESHOLD if threshold is None else threshold))


def with_abstract_and_score(papers: DataFrame) -> DataFrame:
    """Papers with both."""
    return papers.filter((F.trim(F.coalesce("abstract", F.lit(""))) != "") & F.col("relevance_score").try_cast("double").isNotNull())


def distribution(papers: DataFrame, missing: int | None = None, score: str = "relevance_score") -> DataFrame:
    """Papers by score; those without one are left out (A14) or counted under `missing`."""
    rows = papers.filter(F.col(score).isNotNull()) if missing is None else papers.withColumn(score, F.coalesce(score, F.lit(missing)))
    return rows.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("papers")).orderBy("score")


def counters(papers: DataFrame, threshold: int = SCORE_THRESHOLD, score: str = "relevance_score") -> DataFrame:
    """Scored, failed, above and below."""
    s = F.col(score)
    return papers.agg(F.count(F.lit(1)).alias("total"), F.count(s).alias("scored"), F.count_if(s.isNull()).alias("failed"), F.count_if(s >= threshold).alias("above"), F.count_if(s < threshold).alias("below"))


def top(papers: DataFrame, n: int = 20, score: str = "relevance_score", seq: str = "seq") -> DataFrame:
    """The best, first come first of equals."""
    return papers.orderBy(F.col(score).desc_nulls_last(), F.col(seq)).limit(n)


def seeded_sample(papers: DataFrame, n: int = 50, seed: int = 42, key: str = "seq") -> DataFrame:
    """A sample that only seed and keys decide."""
    return papers.filter(F.trim(F.coalesce("title", F.lit(""))) != "").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
