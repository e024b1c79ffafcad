"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.session import scratch_path

#: Characters handled at once by the per-batch numpy code: bounds its memory.
PIECE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage (a lost executor re-reads the files), and lets several
    passes see the very same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{kind}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of
    ``df`` has (compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def text_groups(texts: list[str | None], limit: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a batch whose texts together stay near ``limit`` characters.

    A range holds at least one text, so a longer text stands alone.
    """
    start = size = 0
    for k, text in enumerate(texts):
        n = len(text or "")
        if k > start and size + n > limit:
            yield start, k
            start, size = k, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
