"""Demos: string helpers, surrogate ids, taxonomy and name-list dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.demos.registry import demo
from feedyard.functions.text import ALPHABET, BASE, DIGITS_PER_HALF, POWERS, STRIP_PATTERN, WHITESPACE
from feedyard.functions.text import clean_list, flatten_whitespace, surrogate_key
from feedyard.operators.dims import canonical_taxonomy, match_names, tag_rows, taxonomy_orphans, taxonomy_table
from feedyard.sources.fixtures import table


def _strip_duck(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP_PATTERN}', '', 'g')"


def _norm_duck(x: str) -> str:
    return f"lower(regexp_replace({_strip_duck(x)}, '{WHITESPACE}+', ' ', 'g'))"


# -- O34 ---------------------------------------------------------------------
@demo("clean_list", f"""
SELECT doc_id, CAST(len(l) AS INTEGER) AS n_items, md5(array_to_string(l, chr(1))) AS items_md5
FROM (SELECT doc_id, list_transform(list_filter(string_split(text, chr(10)),
                                                lambda x: x = '' OR {_strip_duck('x')} <> ''), lambda x: {_strip_duck('x')}) AS l
      FROM documents)""")
def clean_list_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cleaned = docs.select("doc_id", clean_list(F.split("text", "\n")).alias("l"))
    return cleaned.select("doc_id", F.size("l").alias("n_items"), F.md5(F.array_join("l", "\u0001")).alias("items_md5"))


# -- O35 ---------------------------------------------------------------------
# The documents have line feeds but no TAB or CR; put some in.
_WITH_TABS_DUCK = "replace(replace(text, '. ', '.' || chr(9)), ', ', ',' || chr(13) || chr(10))"


@demo("flatten_whitespace", f"""
SELECT doc_id, md5(f) AS text_md5, CAST(length(f) AS BIGINT) AS n_chars
FROM (SELECT doc_id, {_strip_duck(f"translate({_WITH_TABS_DUCK}, chr(13) || chr(10) || chr(9), '   ')")} AS f
      FROM documents)""")
def flatten_whitespace_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with_tabs = F.replace(F.replace(F.col("text"), F.lit(". "), F.lit(".\t")), F.lit(", "), F.lit(",\r\n"))
    f = docs.select("doc_id", flatten_whitespace(with_tabs).alias("f"))
    return f.select("doc_id", F.md5("f").alias("text_md5"), F.length("f").cast("bigint").alias("n_chars"))


# -- O36 ---------------------------------------------------------------------
def _half_duck(hex_sql: str) -> str:
    powers = "[" + ", ".join(str(p) for p in POWERS) + "]::BIGINT[]"
    value = f"CAST('0x' || {hex_sql} AS BIGINT)"
    return (f"array_to_string(list_transform(range({DIGITS_PER_HALF - 1}, -1, -1), lambda e: substr('{ALPHABET}', "
            f"CAST(({value} // ({powers})[e + 1]) % {BASE} + 1 AS INTEGER), 1)), '')")


_SK_DUCK = (f"{_half_duck('substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15)')} || "
            f"{_half_duck('substr(md5(CAST(o_orderkey AS VARCHAR)), 16, 15)')}")


@demo("surrogate_key", f"SELECT o_orderkey, {_SK_DUCK} AS sk FROM orders")
def surrogate_key_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", surrogate_key("o_orderkey").alias("sk"))


@demo("surrogate_key_collisions", f"""
SELECT count(*) AS n_keys, count(DISTINCT sk) AS n_ids,
       CAST((SELECT count(*) FROM (SELECT sk FROM (SELECT {_SK_DUCK} AS sk FROM orders) GROUP BY sk HAVING count(*) > 1))
            AS BIGINT) AS n_collisions
FROM (SELECT {_SK_DUCK} AS sk FROM orders)""")
def surrogate_key_collisions_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select(surrogate_key("o_orderkey").alias("sk"))
    per_id = ids.groupBy("sk").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.sum("n").alias("n_keys"), F.count(F.lit(1)).alias("n_ids"),
                      F.count_if(F.col("n") > 1).alias("n_collisions"))


# -- taxonomy fixture ----------------------------------------------------------
# Entries from part: 'p_type;|p_name;' per part, an upper-cased copy every
# 7th part, one without the final ';' every 11th part, and 'p_type;' per
# part except for the smallest p_type (a dropped parent, for the orphan check).
_TAX_DUCK = """
tax AS (
  SELECT p_type || ';|' || p_name || ';' AS entry FROM part
  UNION ALL SELECT upper(p_type || ';|' || p_name || ';') FROM part WHERE p_partkey % 7 = 0
  UNION ALL SELECT p_type || ';|' || p_name FROM part WHERE p_partkey % 11 = 0
  UNION ALL SELECT p_type || ';' FROM part WHERE p_type <> (SELECT min(p_type) FROM part)),
parsed AS (
  SELECT entry, parts[1] AS category, CASE WHEN len(parts) > 1 THEN parts[2] END AS subcategory,
         CAST(len(parts) AS INTEGER) AS level
  FROM (SELECT entry, str_split(regexp_replace(entry, ';$', ''), ';|') AS parts FROM tax))"""

_CANON_DUCK = f"""
canon AS (
  SELECT level, {_norm_duck('category')} AS category_key, coalesce({_norm_duck('subcategory')}, '') AS subcategory_key,
         min(category) AS category, min(subcategory) AS subcategory, count(*) AS n_copies
  FROM parsed GROUP BY 1, 2, 3)"""


def taxonomy_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    pair = F.concat(F.col("p_type"), F.lit(";|"), F.col("p_name"))
    smallest = part.agg(F.min("p_type").alias("p_type"))
    parents = part.join(smallest, on="p_type", how="left_anti")
    parts = [
        part.select(F.concat(pair, F.lit(";")).alias("entry")),
        part.filter(F.col("p_partkey") % 7 == 0).select(F.upper(F.concat(pair, F.lit(";"))).alias("entry")),
        part.filter(F.col("p_partkey") % 11 == 0).select(pair.alias("entry")),
        parents.select(F.concat(F.col("p_type"), F.lit(";")).alias("entry")),
    ]
    return reduce(DataFrame.unionByName, parts)


# -- O37 ---------------------------------------------------------------------
@demo("parse_taxonomy", f"WITH {_TAX_DUCK} SELECT entry, category, subcategory, level FROM parsed")
def parse_taxonomy_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy_table(taxonomy_entries(spark, sf_dir)).select("entry", "category", "subcategory", "level")


# -- O38 ---------------------------------------------------------------------
@demo("canonical_taxonomy", f"WITH {_TAX_DUCK}, {_CANON_DUCK} SELECT * FROM canon")
def canonical_taxonomy_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = canonical_taxonomy(taxonomy_entries(spark, sf_dir))
    return c.select("level", "category_key", "subcategory_key", "category", "subcategory", "n_copies")


@demo("taxonomy_orphans", f"""
WITH {_TAX_DUCK}, {_CANON_DUCK}
SELECT category_key, subcategory_key, category, subcategory FROM canon c
WHERE level = 2 AND NOT EXISTS (SELECT 1 FROM canon p WHERE p.level = 1 AND p.category_key = c.category_key)""")
def taxonomy_orphans_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = taxonomy_orphans(canonical_taxonomy(taxonomy_entries(spark, sf_dir)))
    return o.select("category_key", "subcategory_key", "category", "subcategory")


# -- O39 ---------------------------------------------------------------------
@demo("tag_rows", f"""
WITH {_TAX_DUCK}, {_CANON_DUCK}
SELECT p_partkey, c.category AS tag_category, c.subcategory AS tag_subcategory
FROM part JOIN canon c ON c.level = 2 AND c.category_key = {_norm_duck('p_type')}
                       AND c.subcategory_key = {_norm_duck('p_name')}""")
def tag_rows_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    canon = canonical_taxonomy(taxonomy_entries(spark, sf_dir))
    tagged = tag_rows(table(spark, sf_dir, "part"), canon, "p_type", "p_name")
    return tagged.select("p_partkey", "tag_category", "tag_subcategory")


# -- O40 ---------------------------------------------------------------------
# Name list: the customer names of one market segment, upper-cased and padded.
_NAMES_DUCK = "SELECT upper(c_name) || '  ' AS name FROM customer WHERE c_mktsegment = 'BUILDING'"
_NAME_KEY_DUCK = _norm_duck("translate(c_name, chr(13) || chr(10) || chr(9), '   ')")
_LIST_KEY_DUCK = _norm_duck("translate(name, chr(13) || chr(10) || chr(9), '   ')")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return c.select(F.concat(F.upper("c_name"), F.lit("  ")).alias("name"))


@demo("match_names", f"""
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM ({_NAMES_DUCK}) n WHERE {_LIST_KEY_DUCK} = {_NAME_KEY_DUCK})""")
def match_names_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    return match_names(cust, _names(spark, sf_dir), "c_name").select("c_custkey", "c_name")


@demo("unmatched_names", f"""
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM ({_NAMES_DUCK}) n WHERE {_LIST_KEY_DUCK} = {_NAME_KEY_DUCK})""")
def unmatched_names_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    return match_names(cust, _names(spark, sf_dir), "c_name", matched=False).select("c_custkey", "c_name")
