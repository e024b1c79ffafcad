"""The corpus pipeline: five stages over ``documents``, each on what the one
before it kept.

=================  =====================================================
language           every text is predicted; documents without any letters
                   go (language ``und``); ``lang`` becomes the predicted
                   language where it is null, or contradicted by a
                   prediction with a score of 0.9 or more
line_dedup         boilerplate lines go, but for their first occurrence;
                   a document whose every line went goes with them
near_duplicates    one document of each class of near duplicates stays
decontaminate      documents with a passage of the benchmark go
tokenize           the rest is encoded: digests per document
=================  =====================================================

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents`` (``n_chars`` follows the text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.llm import bpe, decontaminate, language, line_dedup, ngram_join
from feedyard.llm.common import landed, table
from feedyard.llm.queries import held_out

#: The tokenizer file's name (public_tokenizers finds it).
VOCABULARY = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, "doc_id", "text", "lang", may_train=~held_out())


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup.remove_boilerplate(docs, "doc_id", "text", "source")
    emptied = (F.size("lines_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    return done.where(~F.coalesce(emptied, F.lit(False))).select(
        *[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_similar(docs, "doc_id", "text").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_hit(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_texts(docs, "doc_id", "text", public_tokenizers.path(VOCABULARY), digest=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("tokenize", tokenize),
]

#: Banding, trained machines and BPE have no SQL form; a test holds the whole
#: rows of ``run`` against a brute-force model of the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
