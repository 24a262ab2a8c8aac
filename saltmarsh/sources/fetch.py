"""Downloads by an injected fetcher, one host a partition and at its pace."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Takes a URL; gives (status, final URL, body), or raises OSError.
Fetcher = Callable[[str], tuple[int, str, bytes]]
MOST_BYTES, TRIES = 100 << 20, 3


def fetched(urls: DataFrame, fetcher: Fetcher, key: str = "doi", delay: float = 1.0, most_bytes: int = MOST_BYTES, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """key, url, final_url, format (by content, else as asked for), content, error.

    URLs of a host go to one partition, so a host sees one request at a time; after 429 the pause grows. Bodies beyond
    the limit and error pages are errors.
    """
    kind = urls.schema[key].dataType.simpleString()
    host = F.coalesce(F.expr("try_parse_url(url, 'HOST')"), F.lit(""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, url, fmt in zip(batch[key], batch["url"], batch["format"], strict=True):
                final, body, error = None, None, "no answer"
                for attempt in range(TRIES):
                    sleep(delay * 2**attempt if attempt else delay)
                    try:
                        status, final, body = fetcher(url)
                    except OSError as e:
                        error = str(e)
                        continue
                    if status == 429:
                        error = "429"
                        continue
                    error = None if status == 200 else str(status)
                    break
                if error is None and len(body) > most_bytes:
                    error = "too large"
                out.append((k, url, final, fmt, None if error else body, error))
            yield pd.DataFrame(out, columns=[key, "url", "final_url", "asked", "content", "error"])

    rows = urls.select(key, "url", "format").repartition(host)
    got = rows.mapInPandas(run, f"{key} {kind}, url string, final_url string, asked string, content binary, error string")
    head = F.decode(F.substring("content", 1, 5000), "ISO-8859-1")
    bad = (F.octet_length("content") < 120) | ((F.col("asked") != "pdf") & (X.count_markers(F.lower(head), X.V.ERROR_MARKERS) > 0) & ~head.startswith("%PDF"))
    error = F.coalesce("error", F.when(bad, "small or error body"))
    return got.select(key, "url", "final_url", F.coalesce(X.content_format(head), "asked").alias("format"), F.when(error.isNull(), F.col("content")).alias("content"), error.alias("error"))
