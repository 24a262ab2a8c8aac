"""Structures: choosing, classifying, and the ordered fold that keeps one row a structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chem
from ..functions import text as X
from ..functions.values import NOT_FOUND
from ..storage import if_small


def found(c: str) -> Column:
    t = F.trim(F.coalesce(F.col(c), F.lit("")))
    return F.when((t != "") & (t != NOT_FOUND), t)


def chosen_smiles(paper: str = "paper_smiles", database: str = "pubchem_canonical_smiles") -> tuple[Column, Column]:
    """The paper's structure before the database's, and which it is."""
    p, d = found(paper), found(database)
    return F.coalesce(p, d, F.lit(NOT_FOUND)), F.when(p.isNotNull(), "paper").when(d.isNotNull(), "pubchem").otherwise("none")


def display_name(compat: bool = False) -> Column:
    """resolved_name, compound_name or iupac_name (X30); by default the sentinel does not hide a name, as it does in the source system (`compat`)."""
    pick = (lambda c: X.present(F.col(c))) if compat else found
    return F.coalesce(X.present(F.trim(F.coalesce(pick("resolved_name"), pick("compound_name"), pick("iupac_name")))), F.lit(NOT_FOUND))


def final_type(family: str = "ao_family") -> Column:
    """phenolic, aminic or other."""
    return F.when(F.col(family) == "phenolic", "phenolic").when(F.col(family) == "aminic_nh", "aminic").otherwise("other")


def structure_rows(links: DataFrame, compat: bool = False) -> DataFrame:
    """seq, cid, name, smiles, type, heavy_atoms of link rows (P10); each distinct structure is parsed once."""
    rows = links.select("seq", F.coalesce(X.present(F.trim("cid")), F.lit(NOT_FOUND)).alias("cid"), display_name(compat).alias("name"), chosen_smiles()[0].alias("smiles_used"))
    parsed = chem.parsed_once(rows.filter(F.col("smiles_used") != NOT_FOUND), "smiles_used")
    out = rows.join(if_small(parsed), "smiles_used", "left")
    good = F.col("canonical_smiles").isNotNull()
    return out.select("seq", "cid", "name", F.coalesce("canonical_smiles", F.lit(NOT_FOUND)).alias("smiles"), F.when(good, final_type()).otherwise("other").alias("type"), "heavy_atoms")


def fold_structures(rows: DataFrame) -> DataFrame:
    """One row a structure (or a name without one), by the order-dependent rule of preference.

    The rule is not associative, so each group is folded in order of seq; exact repeats of (cid, name,
    type) within a group cannot change the outcome and are dropped before the group is gathered: its size is the
    number of its different spellings.
    """
    key = F.when(F.col("smiles") == NOT_FOUND, F.concat(F.lit("missing::"), F.lower("name"), F.lit("::"), "cid")).otherwise(F.col("smiles"))
    once = rows.groupBy(key.alias("_key"), "cid", "name", "smiles", "type").agg(F.min("seq").alias("seq"), F.min("heavy_atoms").alias("heavy_atoms"))
    entry = F.struct("seq", "cid", "name", "smiles", "type", "heavy_atoms")
    prior = lambda x: x["type"].isin("phenolic", "aminic").cast("int")

    def better(old: Column, new: Column) -> Column:
        longer = (new["name"] != NOT_FOUND) & ((old["name"] == NOT_FOUND) | (F.length(new["name"]) > F.length(old["name"])))
        return F.when((prior(new) > prior(old)) | longer | ((old["cid"] == NOT_FOUND) & (new["cid"] != NOT_FOUND)), new).otherwise(old)

    listed = once.groupBy("_key").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    folded = listed.select(F.aggregate(F.slice("l", 2, F.greatest(F.size("l") - 1, F.lit(0))), F.element_at("l", 1), better).alias("r"))
    return folded.select("r.cid", "r.name", "r.smiles", "r.type", "r.heavy_atoms").orderBy("type", F.lower("name"), "cid", "smiles")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Priority and other rows."""
    return rows.filter(F.col("type").isin("phenolic", "aminic")), rows.filter(F.col("type") == "other")


def type_counts(rows: DataFrame) -> DataFrame:
    """Rows and largest heavy-atom count by type."""
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max("heavy_atoms"), F.lit(0)).alias("max_heavy_atoms"))
