"""Line de-duplication by the spread of lines over sites.

A line that stands on many distinct sites is boilerplate. Distinct sites per
line are first sketched: one HyperLogLog sketch per line hash, merged by
aggregation, so a hot line is reduced before its shuffle. Lines whose
estimate lies near the threshold get an exact distinct count; for the others
the estimate decides. Boilerplate lines are removed everywhere but at their
first occurrence (smallest document id, then row hashes, then position), so no
content is lost from the corpus and one distinct document keeps the line.

Lines are compared by two 64-bit hashes of their trimmed text. A line of
fewer than ``min_words`` words is never boilerplate: short sentences recur by
chance. Words are counted by spaces or, where that finds too few, by any
Unicode white space and in scripts without spaces by length: two characters
of Han or Hiragana, four of Katakana, Thai, Lao, Khmer or Myanmar are a word.

Defined results: null texts stay null; empty texts have no boilerplate; null
sites count as no site; rows with equal id and text are one document to the
first-occurrence rule and share their removals; null ids come before all
others; an empty table gives an empty result; further columns are kept as
they are by ``remove_boilerplate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedyard.llm.common import free_names, landed, let

#: What orders the occurrences of a line.
PLACE = ("_id", "_row1", "_row2", "_pos")
#: Distinct sites from which a line is boilerplate.
MIN_SITES = 8
#: Words below which a line is left alone.
MIN_WORDS = 3
#: A word of a line in any script; begun words of unspaced scripts count.
_PAIRS, _FOURS = r"\p{IsHan}\p{IsHiragana}", r"\p{IsKatakana}\u30FC\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"(?U)[{_PAIRS}]{{1,2}}+|[{_FOURS}]{{1,4}}+|[\w&&[^{_PAIRS}{_FOURS}]][^\s{_PAIRS}{_FOURS}]*+"
#: log2 of the sketch's registers: about 1.6 % standard error.
LOG_K = 12
#: Estimates within this factor of the threshold are counted exactly.
NEAR = 1.5


def _row_key(id_col: str, text_col: str) -> dict[str, Column]:
    return {
        "_row1": F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)),
        "_row2": F.xxhash64(F.lit(2), F.col(id_col), F.col(text_col)),
    }


def site_lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int) -> DataFrame:
    """One row per line that could be boilerplate: its place and its hashes."""
    lines = docs.select(
        F.col(id_col).alias("_id"), F.col(site_col).cast("string").alias("_site"),
        *[c.alias(k) for k, c in _row_key(id_col, text_col).items()],
        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("_pos", "_line"),
    ).withColumn("_line", F.trim("_line"))
    spaced = F.char_length("_line") - F.char_length(F.translate("_line", " ", ""))
    return lines.where((spaced >= min_words - 1) | (F.regexp_count("_line", F.lit(WORD)) >= min_words)).select(
        "_id", "_site", "_row1", "_row2", "_pos",
        F.xxhash64(F.lit(1), "_line").alias("_h1"), F.xxhash64(F.lit(2), "_line").alias("_h2"),
    )


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """_h1, _h2, _sites, _keep of the lines on ``min_sites`` sites or more.

    ``_sites`` is exact near the threshold and an estimate above; ``_keep``
    is the first occurrence (id, row hashes, position).
    """
    spread = lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", LOG_K)).alias("_sites"),
        F.min(F.struct(*PLACE)).alias("_keep"),
        F.count("*").alias("_n"),
    ).where((F.col("_sites") * NEAR >= min_sites) & (F.col("_n") >= min_sites))
    spread = landed(spread.drop("_n"), "line-spread")
    far = spread.where(F.col("_sites") > min_sites * NEAR)
    near = spread.where(F.col("_sites") <= min_sites * NEAR)
    counted = (
        # distinct (line, site) pairs first: a hot line is reduced map-side
        lines.join(near.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
        .where(F.col("_site").isNotNull())
        .groupBy("_h1", "_h2", "_site").agg(F.lit(1).alias("_one"))
        .groupBy("_h1", "_h2").agg(F.count("*").alias("_sites"))
        .where(F.col("_sites") >= min_sites)
    )
    return far.unionByName(near.drop("_sites").join(counted, ["_h1", "_h2"]))


def remove_boilerplate(
    docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and the column
    ``lines_removed`` (array of 0-based line positions; replaces any before)."""
    lines = landed(site_lines(docs, id_col, text_col, site_col, min_words), "site-lines")
    boiler = boilerplate_lines(lines, min_sites)
    gone = (
        lines.join(boiler.select("_h1", "_h2", "_keep"), ["_h1", "_h2"])
        .where(~F.struct(*PLACE).eqNullSafe(F.col("_keep")))
        .groupBy("_row1", "_row2").agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
    )
    text = F.col(text_col)
    row1, row2, taken = free_names(docs, "row1", "row2", "gone")
    gone = gone.toDF(row1, row2, taken)
    # the positions that stay, then their lines: linear in the lines of a text
    kept = let(F.split(text, "\n", -1), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(taken)), lambda k: F.get(lines, k)), "\n"))
    keys = dict(zip((row1, row2), _row_key(id_col, text_col).values()))
    return (
        docs.drop("lines_removed").withColumns(keys).join(gone, [row1, row2], "left")
        .withColumn(text_col, F.when(F.col(taken).isNull(), text).otherwise(kept))
        .withColumn("lines_removed", F.coalesce(taken, F.array().cast("array<int>")))
        .drop(row1, row2, taken)
    )
