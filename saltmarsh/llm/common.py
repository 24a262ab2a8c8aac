"""Helpers shared by the training-data operators: shared storage, checked broadcasts, Arrow chunks."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a broadcast side may have; beyond it the callers take a shuffled plan.
BROADCAST_ROWS = 1_000_000
#: The setting for the bytes of a batch, and the bound.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)
_SPLITS = "spark.sql.files.minPartitionNum"
_PACKAGE = Path(__file__).resolve().parents[1]
_LIBC = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can reach (spark.checkpoint.dir); set here only where it is unset and all run on one machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='saltmarsh-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/saltmarsh/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet into the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _written(spark).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saltmarsh_path = path
    return out


def _written(spark: SparkSession) -> list[str]:
    """The paths of this context's stored tables that are not swept yet."""
    sc = spark.sparkContext
    if not hasattr(sc, "_saltmarsh_written"):
        sc._saltmarsh_written = []
    return sc._saltmarsh_written


def sweep(spark: SparkSession, since: int, *kept: DataFrame) -> None:
    """Deletes the stored tables written after the first `since`, but for those in `kept` (as `stored` gave them).

    The driver's garbage is collected too: Spark deletes the shuffle files of plans that nothing refers to only then.
    """
    keep, written = {getattr(df, "_saltmarsh_path", None) for df in kept}, _written(spark)
    for path in written[since:]:
        if path not in keep:
            remove_path(spark, path)
    written[since:] = [path for path in written[since:] if path in keep]
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored_so_far(spark: SparkSession) -> int:
    """For `sweep`: how many stored tables there are."""
    return len(_written(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder through Hadoop's file system of its scheme."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> None:
    """Deletes all that `stored` and the writers left in the shared folder, once no result needs it."""
    remove_path(spark, f"{shared_dir(spark)}/saltmarsh")


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint where its counted rows are within the bound, else unhinted (AQE joins it by shuffle)."""
    return F.broadcast(df) if is_small(df, rows) else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table has at most `rows` rows."""
    return df.limit(rows + 1).count() <= rows


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a context, so that they need no shared installation.

    It also fixes the splits of file scans for the session, and bounds the bytes of a batch that goes to a worker, unless the session has a bound of its own: rows may be
    long, and each worker holds a batch beside what it makes of it.
    """
    sc = spark.sparkContext
    if spark.conf.get(_SPLITS, None) is None:
        # the splits of a file scan follow the registered cores unless fixed; row tags need the same ones at each reading
        spark.conf.set(_SPLITS, str(sc.defaultParallelism))
    if int(spark.conf.get(BATCH_BYTES[0]).rstrip("bB")) > BATCH_BYTES[1]:
        spark.conf.set(BATCH_BYTES[0], str(BATCH_BYTES[1]))
    if getattr(sc, "_saltmarsh_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="saltmarsh-code-"), "saltmarsh-package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(_PACKAGE.parent))
    sc.addPyFile(target)
    sc._saltmarsh_shipped = True


def text_or_empty(name: str = "text") -> Column:
    """The column as a string, null counting as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def free_name(taken: list[str], name: str) -> str:
    """`name`, with underscores in front until no column of `taken` has it in any case."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def uniform(*keys: Column | str, seed: int) -> Column:
    """A reproducible number in [0, 1) of the keys and the seed: the first 52 bits of an MD5, which other engines have too."""
    parts = [F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"), F.lit("null")) for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def held_out(name: str = "doc_id") -> Column:
    """Rows no model may learn from: crc32 of the id as text is a multiple of 5."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % 5 == 0


#: What operators keep in a worker between their tasks: by operator, how to let go of it.
KEPT: dict[str, Callable[[], None]] = {}


def give_back() -> None:
    """Returns freed memory to the system: workers are kept for later tasks, and idle ones would hold it beside the JVM."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20, operator: str = "") -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose `column` holds about `max_bytes` at most (one row where a single value is longer).

    What other operators than `operator` keep in this worker is let go first.
    """
    for other in [k for k in KEPT if k != operator]:
        KEPT.pop(other)()
    values = batch.column(batch.schema.get_field_index(column))
    sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > max_bytes:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)
    give_back()
