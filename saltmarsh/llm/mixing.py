"""Mixing sources to target weights.

Words are summed per source, target sizes give each source a repetition rate, and a document is
emitted floor(rate) times plus one more copy by a Bernoulli draw of its hashed id, with the rate's
fraction as the probability. Only DataFrame operations are used; nothing but the table of sources
(one row each) is gathered.

Nulls: a null text has size 0; null is a source of its own, last in order; a null id draws as the
text "null". Empty texts have size 0 and are repeated as any other. Repeated rows draw alike (the draw is a
function of id and seed). A source without words gets target 0 and is not taken; an empty table
gives an empty result. Columns beside those named pass through `mix` unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, if_small, stored, text_or_empty, uniform

WORD = r"[^\x20\x09-\x0D]+"
SEED = 20
MAX_REPEATS = 3
#: The table of sources is broadcast up to so many rows; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 50_000


def word_count(text: str = "text") -> Column:
    """Number of runs of characters that are not ASCII white space, as long."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def cyclic_weight(source: str = "source", cycle: int = 3) -> Column:
    """1, 2, ... `cycle`, repeating over the sources in code point order, null last. For the table of sources only."""
    return ((F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1) % cycle + 1).cast("long")


def source_targets(sizes: DataFrame, weight: Column | None = None, max_repeats: int = MAX_REPEATS, source: str = "source", size: str = "size") -> DataFrame:
    """Per source: source_size, weight, target (double).

    The sources share the total of all sizes by weight; a target stops at `max_repeats` times its
    source's size and the excess is shared anew by weight until none is above. With sources ordered
    by limit over weight those that stop are a prefix, so running sums give the fixed point at once;
    the comparison is exact (38-digit integers).
    """
    big = lambda c: c.cast("decimal(38,0)")
    per = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    per = per.withColumn("weight", cyclic_weight(source) if weight is None else weight.cast("long")).withColumn("_limit", F.col("source_size") * max_repeats)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("_limit") / F.col("weight"), F.col(source).asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumns({"_total": F.sum("source_size").over(every), "_stopped": F.coalesce(F.sum("_limit").over(before), F.lit(0)), "_weights": F.sum("weight").over(after)})
    per = per.withColumn("_stops", big(F.col("_limit")) * big(F.col("_weights")) < big(F.col("weight")) * big(F.col("_total") - F.col("_stopped")))
    left = F.col("_total") - F.sum(F.when(F.col("_stops"), F.col("_limit")).otherwise(0)).over(every)
    free = F.sum(F.when(F.col("_stops"), 0).otherwise(F.col("weight"))).over(every)
    per = per.withColumns({"_left": left, "_free": free})
    shared = (F.col("weight") * F.col("_left")).cast("double") / F.col("_free").cast("double")
    return per.select(source, "source_size", "weight", F.when(F.col("_stops"), F.col("_limit").cast("double")).otherwise(shared).alias("target"))


def copies(rate: Column, id_column: str, seed: int = SEED) -> Column:
    """floor(rate) plus one where the id's draw is below the fraction."""
    whole = F.floor(rate)
    return (whole + F.when(uniform(id_column, seed=seed) < rate - whole, 1).otherwise(0)).cast("long")


def mix_counts(docs: DataFrame, weight: Column | None = None, max_repeats: int = MAX_REPEATS, seed: int = SEED, id_column: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with size, source_size, target and copies, under free names of the returned frame's attribute `mix_columns`."""
    names = {k: free_name(docs.columns, k) for k in ("size", "source_size", "target", "copies")}
    sized = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)], word_count(text).alias(names["size"]))
    per = source_targets(docs.select(F.col(source).alias("source"), word_count(text).alias("size")), weight, max_repeats)
    per = stored(per.select(F.col("source").alias("_mix_source"), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"])), "mix-sources")
    joined = sized.join(if_small(per, BROADCAST_SOURCES), F.col(f"`{source}`").eqNullSafe(F.col("_mix_source"))).drop("_mix_source")
    rate = F.when(F.col(names["source_size"]) > 0, F.col(names["target"]) / F.col(names["source_size"])).otherwise(F.lit(0.0))
    out = joined.withColumn(names["copies"], copies(rate, id_column, seed))
    out.mix_columns = names
    return out


def mix(docs: DataFrame, weight: Column | None = None, max_repeats: int = MAX_REPEATS, seed: int = SEED, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus: each row of `docs` as many times as the mix takes it, with the columns of `docs`."""
    counted = mix_counts(docs, weight, max_repeats, seed, id_column, text, source)
    n = counted.mix_columns["copies"]
    once = free_name(counted.columns, "once")
    repeated = counted.filter(F.col(n) > 0).withColumn(once, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
