"""Dimension operators: taxonomy tables and name lists (inputs, not code).

Memberships are equi-joins on a normalised value. Dimension tables are
small in practice, but their size is not assumed: AQE turns a join into a
broadcast only when the measured side is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedyard.functions.text import flatten_whitespace, normalize, parse_taxonomy


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- O37 (table form) ------------------------------------------------------------
def taxonomy_table(entries: DataFrame, col: str = "entry") -> DataFrame:
    """entry -> entry, category, subcategory, level."""
    return entries.select(F.col(col).alias("entry"), parse_taxonomy(col).alias("t")).select("entry", "t.*")


# -- O38 ---------------------------------------------------------------------
def canonical_taxonomy(entries: DataFrame, col: str = "entry") -> DataFrame:
    """One row per case- and space-insensitive entry: level, normalised keys,
    a canonical spelling (the smallest original one) and the copy count."""
    t = taxonomy_table(entries, col)
    t = t.withColumn("category_key", normalize("category")).withColumn(
        "subcategory_key", F.coalesce(normalize("subcategory"), F.lit("")))
    return t.groupBy("level", "category_key", "subcategory_key").agg(
        F.min("category").alias("category"), F.min("subcategory").alias("subcategory"),
        F.count(F.lit(1)).alias("n_copies"))


def taxonomy_orphans(canonical: DataFrame) -> DataFrame:
    """Second-level entries whose parent category is not listed itself."""
    parents = canonical.filter(F.col("level") == 1).select(F.col("category_key").alias("_parent"))
    children = canonical.filter(F.col("level") == 2)
    return children.join(parents, children["category_key"] == parents["_parent"], "left_anti")


# -- O39 ---------------------------------------------------------------------
def tag_rows(df: DataFrame, canonical: DataFrame, category_col: str, subcategory_col: str | None = None,
             how: str = "inner") -> DataFrame:
    """Attach (category, subcategory) to rows whose values are in the taxonomy.

    ``how='inner'`` keeps tagged rows only, ``'left'`` keeps all rows,
    ``'left_semi'`` filters rows by membership without attaching.
    """
    level = 2 if subcategory_col else 1
    dim = canonical.filter(F.col("level") == level).select(
        F.col("category_key").alias("_ck"), F.col("subcategory_key").alias("_sk"),
        F.col("category").alias("tag_category"), F.col("subcategory").alias("tag_subcategory"))
    keyed = df.withColumn("_ck_row", normalize(category_col))
    cond = keyed["_ck_row"] == dim["_ck"]
    if subcategory_col:
        keyed = keyed.withColumn("_sk_row", normalize(subcategory_col))
        cond = cond & (keyed["_sk_row"] == dim["_sk"])
    out = keyed.join(dim, cond, how)
    return out.drop("_ck", "_sk", "_ck_row", "_sk_row")


# -- O40 ---------------------------------------------------------------------
def name_key(c: Column | str) -> Column:
    """Names compare after flattening CR/LF/TAB, collapsing spaces and lower-casing."""
    return normalize(flatten_whitespace(c))


def match_names(df: DataFrame, names: DataFrame, col: str, names_col: str = "name", matched: bool = True) -> DataFrame:
    """Rows whose ``col`` is on the name list (``matched=False``: the rest)."""
    keys = names.select(name_key(names_col).alias("_name_key")).filter(F.col("_name_key") != "")
    keyed = df.withColumn("_row_key", name_key(col))
    out = keyed.join(keys, keyed["_row_key"] == keys["_name_key"], "left_semi" if matched else "left_anti")
    return out.drop("_row_key")
