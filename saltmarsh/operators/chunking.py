"""Chunks of long texts, and matching files to metadata."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.values import CHUNK_CHARS, CHUNK_OVERLAP


#: Bytes of text that a worker holds as pieces before it gives them back.
PIECE_BYTES = 2 << 20


def cut_points(text: str, most: int, overlap: int) -> list[tuple[int, int]]:
    """Begin and end of each chunk: cut at the last blank line of the final 500 characters, else after the last full stop of the final 300, else hard."""
    n, begin, out = len(text), 0, []
    if n <= most:
        return [(0, n)]
    while begin < n:
        end = min(begin + most, n)
        if end < n:
            blank = text.rfind("\n\n", max(begin, end - 500), end)
            stop = text.rfind(". ", max(begin, end - 300), end) if blank <= begin else -1
            end = blank if blank > begin else stop + 1 if stop > begin else end
        out.append((begin, end))
        if end < n and end - overlap <= begin:
            raise ValueError("the overlap leaves no progress")
        begin = end - overlap if end < n else n
    return out


def chunks(papers: DataFrame, most: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP, key: str = "paper_id", text: str = "text") -> DataFrame:
    """key, chunk_no, chunk_id, char_start, char_end, chunk_text (X11, W02). Short texts never leave the JVM; blank chunks are not numbered."""
    if not 0 <= overlap < most - 500:
        raise ValueError("the overlap must be smaller than a chunk less 500")
    body = F.coalesce(F.col(text), F.lit(""))
    columns = [key, "chunk_no", "chunk_id", "char_start", "char_end", "chunk_text"]
    rows = papers.select(F.col(key), body.alias("_body"))
    short = rows.filter(F.length("_body") <= most).select(key, F.lit(1).alias("chunk_no"), F.concat(F.col(key).cast("string"), F.lit(":chunk-1")).alias("chunk_id"), F.lit(0).alias("char_start"), F.length("_body").alias("char_end"), F.col("_body").alias("chunk_text"))
    schema = f"{key} {papers.schema[key].dataType.simpleString()}, chunk_no int, chunk_id string, char_start int, char_end int, chunk_text string"
    return short.unionByName(rows.filter(F.length("_body") > most).mapInArrow(lambda batches: pieces(batches, most, overlap, columns), schema))


def pieces(batches: Iterator[pa.RecordBatch], most: int, overlap: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Chunks of the texts (second column) of batches, given back by `PIECE_BYTES` of text, be a batch or a text as long as it may."""
    for batch in batches:
        types = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        whole = lambda rows: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types, strict=True)], names=columns)  # noqa: B023, E731
        out, size = [], 0
        for i in range(batch.num_rows):
            k, t, n = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), 0
            for a, b in cut_points(t, most, overlap):
                if piece := t[a:b].strip():
                    n += 1
                    out.append((k, n, f"{k}:chunk-{n}", a, b, piece))
                    size += len(piece)
                    if size >= PIECE_BYTES:
                        yield whole(out)
                        out, size = [], 0
        if out:
            yield whole(out)
        pa.default_memory_pool().release_unused()


def match_metadata(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Files (file_stem, …) with the metadata of their DOI, else of their slug (J07); the last metadata of a key counts."""
    f = files.withColumns({"file_doi": X.filename_doi("file_stem"), "file_year": X.filename_year("file_stem")})
    f = f.withColumns({"_d": X.normal_doi("file_doi"), "_s": X.slug("file_doi")})
    fields = ["doi", "title", "year", "abstract"]
    last = lambda k: metadata.filter(k.isNotNull()).groupBy(k.alias("_k")).agg(F.max_by(F.struct(*fields), "seq").alias("m"))
    by_doi = last(X.normal_doi("doi")).select(F.col("_k").alias("_d"), F.col("m").alias("_by_doi"))
    by_slug = last(X.slug(X.normal_doi("doi"))).select(F.col("_k").alias("_s"), F.col("m").alias("_by_slug"))
    out = f.join(by_doi, "_d", "left").join(by_slug, "_s", "left").withColumn("_m", F.coalesce("_by_doi", "_by_slug"))
    found = F.col("_m").isNotNull()
    pick = [F.coalesce(X.present(F.col("_m.doi")), F.col("file_doi")).alias("doi"), F.coalesce(F.col("_m.year").cast("string"), F.col("file_year")).alias("year"), X.present(F.col("_m.title")).alias("title"), X.present(F.col("_m.abstract")).alias("abstract"), found.alias("metadata_found")]
    return out.select(*files.columns, *pick)


def metadata_only(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """Papers with an abstract but no file: their abstract is the text."""
    have = files.select(X.normal_doi(X.filename_doi("file_stem")).alias("_d")).filter("_d IS NOT NULL").distinct()
    rows = metadata.withColumn("_d", X.normal_doi("doi")).join(have, "_d", "left_anti").filter(X.clean("abstract") != "")
    return rows.drop("_d").withColumns({"text": X.clean("abstract"), "source": F.lit("metadata_only")})


def upgrade_cache(cached: DataFrame, new: DataFrame, key: str = "paper_id") -> DataFrame:
    """The cache with new records: a full text replaces an abstract, else only blank fields are filled."""
    names = [c for c in cached.columns if c != key]
    c, n = cached.select(key, F.struct(*names).alias("c")), new.select(key, F.struct(*names).alias("n"))
    both = c.join(n, key, "full_outer")
    replace = F.col("c").isNull() | ((F.col("c.source") == "metadata_only") & (F.col("n.source") != "metadata_only"))
    pick = [F.when(replace, F.col(f"n.{x}")).otherwise(F.coalesce(F.nullif(F.col(f"c.{x}").cast("string"), F.lit("")).cast(cached.schema[x].dataType), F.col(f"n.{x}"))).alias(x) for x in names]
    return both.select(key, *pick)
