"""Reading and writing the files between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bibtex
from ..functions import text as X
from ..operators.fulltext import labelled_text


def read_papers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Papers of JSON files that are a list, {papers}, {items} or one object (S10 to S12), with `seq` by file and place.

    `seq` is the file's number in order of names times 2^40 plus the place, so it tells papers of several files apart. A file is one value, as JSON without lines cannot be split; for large inputs use JSON lines or Parquet.
    """
    whole = spark.read.text(path, wholetext=True).withColumn("_v", F.try_parse_json("value"))
    lists = F.coalesce(*[F.try_variant_get("_v", p, "array<variant>") for p in ("$.papers", "$.items", "$")], F.array("_v"))
    rows = whole.select(F.input_file_name().alias("_f"), F.posexplode(lists).alias("_n", "v")).select("_f", "_n", F.from_json(F.to_json("v"), schema).alias("r"))
    names = sorted(spark.read.text(path, wholetext=True).inputFiles())
    if len(names) < 2:
        return rows.select(F.col("_n").cast("bigint").alias("seq"), "r.*")
    numbers = spark.createDataFrame(list(enumerate(names)), "_no bigint, _name string")  # a row a file
    # the two name the same file in forms that differ in slashes and escapes
    key = lambda c: F.regexp_replace(F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    rows = rows.join(numbers.select(key("_name").alias("_k"), "_no"), key("_f") == F.col("_k"))
    return rows.select((F.col("_no") * (1 << 40) + F.col("_n")).alias("seq"), "r.*")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, names trimmed, NUL characters removed."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    named = raw.toDF(*[c.strip() for c in raw.columns])
    return named.select(*[F.replace(F.col(f"`{c}`"), F.lit("\x00"), F.lit("")).alias(c) for c in named.columns])


def priority_results(rows: DataFrame) -> DataFrame:
    """Type in lower case, other by default; rows without a structure are left out."""
    return rows.withColumns({"type": F.coalesce(X.present(F.lower(F.trim("type"))), F.lit("other")), "smiles": X.found_or_empty("smiles")}).filter("smiles <> ''")


def other_results(rows: DataFrame) -> DataFrame:
    """The same with type other."""
    return priority_results(rows).withColumn("type", F.lit("other"))


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header and without control characters."""
    clean = [X.without_control(c).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    rows.select(*clean).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_enveloped(papers: DataFrame, path: str, about: dict) -> None:
    """Papers as JSON lines below path/papers and one line about them below path/metadata."""
    spark = papers.sparkSession
    papers.write.mode("overwrite").json(f"{path}/papers")
    head = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"), *[F.lit(v).alias(k) for k, v in about.items()])
    head.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def append_log(rows: DataFrame, path: str) -> None:
    """More lines of an append-only log."""
    rows.write.mode("append").json(path)


def write_bibtex(papers: DataFrame, path: str) -> None:
    """Entries with a blank line between them (K06); rows carry `position`."""
    papers.select(bibtex.entry().alias("value")).write.mode("overwrite").option("lineSep", "\n\n").text(path)


def write_labelled(docs: DataFrame, path: str) -> None:
    """One labelled text a row, partitioned by label (K08, K09); the file name is a column beside it."""
    name = F.concat(F.coalesce(X.present(F.trim(F.col("year").cast("string"))), F.lit("unknown")), F.lit("_"), X.safe_file(F.replace("doi", F.lit("/"), F.lit("__")), 200), F.lit(".txt"))
    docs.select("label", name.alias("file_name"), labelled_text().alias("content")).write.mode("overwrite").partitionBy("label").parquet(path)


def write_embedding_points(rows: DataFrame, path: str) -> None:
    """Points of a plot as CSV."""
    write_csv(rows.select("name", "type", "smiles", *[c for c in rows.columns if c.endswith(("_1", "_2"))]), path)


def plot_stats(stats: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: the data set's counts with the papers by score."""
    counted = scores.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("relevance_score").cast("string"), "papers")))).alias("paper_score_counts"))
    return stats.crossJoin(F.broadcast(counted))  # one row by one row


def stored_or_made(spark: SparkSession, path: str, make, refresh: bool = False) -> DataFrame:
    """The JSON lines at `path`, made and written first where there are none or `refresh` asks for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if refresh or not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        made = make()
        made.write.mode("overwrite").json(path)
        return spark.read.schema(made.schema).json(path)
    return spark.read.json(path)


def clear_outputs(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Deletes these files or folders below an output folder; which there were."""
    gone = []
    for name in names:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True):
            gone.append(name)
    return gone
