"""Calls of a language model over chunks: prompts, retries, counts, readiness."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

#: A prompt to the model's answer; None or an exception is a failure.
Backend = Callable[[str], str | None]
# Options of an extraction call, its tries, and the form of a scoring answer
EXTRACTION_OPTIONS = {"format": "json", "temperature": 0.1, "num_predict": 2048}
TRIES, BACKOFF = 3, 2.0
SCORE_SCHEMA = {"type": "object", "properties": {"score": {"type": "integer"}, "reason": {"type": "string"}}, "required": ["score", "reason"]}


def extraction_options(num_ctx: int = 0, think: bool | None = None) -> dict:
    """Options of an extraction call with a context window and thinking where they are set."""
    return EXTRACTION_OPTIONS | ({"num_ctx": num_ctx} if num_ctx else {}) | ({} if think is None else {"think": think})


def with_extraction_prompt(chunks: DataFrame, template: str, text: str = "chunk_text", column: str = "prompt") -> DataFrame:
    """`template` with {text} filled in and double braces as single ones."""
    pieces = [F.lit(p.replace("{{", "{").replace("}}", "}")) for p in template.split("{text}")]
    body = F.coalesce(F.col(text), F.lit(""))
    parts = [pieces[0]]
    for p in pieces[1:]:
        parts += [body, p]
    return chunks.withColumn(column, F.concat(*parts))


def with_calls(rows: DataFrame, backend: Backend, prompt: str = "prompt", tries: int = TRIES, backoff: float = BACKOFF, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """`rows` with answer, succeeded, attempts and seconds of a call each.

    A failed try is followed by a pause of backoff to the power of its number. A null prompt is not sent and has failed.
    """
    added = [StructField("answer", StringType()), StructField("succeeded", BooleanType()), StructField("attempts", IntegerType()), StructField("seconds", DoubleType())]

    def call(text: str | None) -> tuple[str | None, bool, int, float]:
        began, number = time.monotonic(), 0
        while text is not None and number < tries:
            number += 1
            try:
                answer = backend(text)
            except Exception:  # whatever the client raises is a failed try
                answer = None
            if answer is not None:
                return answer, True, number, time.monotonic() - began
            sleep(backoff**number)
        return None, False, number, time.monotonic() - began

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = pd.DataFrame([call(t) for t in batch[prompt].tolist()], columns=[f.name for f in added], index=batch.index)
            yield pd.concat((batch, got), axis=1)

    return rows.mapInPandas(run, StructType([*rows.schema.fields, *added]))


def call_stats(called: DataFrame) -> DataFrame:
    """Calls, seconds, successes, failures and seconds a call."""
    seconds = F.coalesce(F.sum("seconds"), F.lit(0.0))
    n = F.count(F.lit(1))
    return called.agg(n.alias("chunks"), seconds.alias("total_seconds"), F.count_if("succeeded").alias("successes"), F.count_if(~F.col("succeeded")).alias("failures"), F.when(n > 0, seconds / n).otherwise(0.0).alias("avg_seconds_per_chunk"))


def ready_hosts(hosts: list[str], models: Callable[[str], list[str]], most_wait: float = 120, pause: float = 3, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> list[str]:
    """The hosts that list their models before the wait is over."""
    ready, began = [], clock()
    for host in hosts:
        while True:
            try:
                models(host)
                ready.append(host)
                break
            except Exception:  # not up yet
                if clock() - began + pause > most_wait:
                    break
                sleep(pause)
    return ready


def ensure_model(host: str, model: str, models: Callable[[str], list[str]], pull: Callable[[str, str], None]) -> bool:
    """Whether the host has the model, fetched if need be."""
    try:
        if model not in models(host):
            pull(host, model)
        return True
    except Exception:  # the caller decides what to do without the model
        return False
