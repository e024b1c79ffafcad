"""Page envelopes: the landed JSON documents the source service returns.

One document per (feed, window, page): ``{"feed": .., "window_start": ..,
"page_no": .., "response": {"result": [record, ...]}}``. The three identity
keys are written by the fetcher that lands the page; the service's own body
is the ``response`` part. Documents are stored one per line (JSON Lines):
a scan of plain files splits across tasks by file block, one of gzipped files
(``land_envelopes``) by file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedyard.operators.paging import assign_pages
from feedyard.schema import PAGE_SIZE, Feed, feed as get_feed

CORRUPT = "_corrupt_record"


#: A record type without any field that a record has: its values are skipped, not built.
SKIPPED = T.StructType([T.StructField("_skipped", T.StringType())])


def envelope_schema(feed: Feed, record: T.StructType | None = None) -> T.StructType:
    """Explicit schema: no inference pass over the landed data."""
    return T.StructType([
        T.StructField("feed", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("window_start", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("response", T.StructType([
            T.StructField("result", T.ArrayType(record or feed.record_schema())),
        ])),
        T.StructField(CORRUPT, T.StringType()),
    ])


# -- O1 ----------------------------------------------------------------------
def parse_envelopes(text: DataFrame, feed: str | Feed, value: str = "value") -> DataFrame:
    """Decode envelope documents held in a text column.

    Output: feed, run, window_start (date), page_no, records (array of
    structs), n_records, and for a bad document ``_corrupt_record`` (its raw
    text) and ``bad_reason``: it does not decode, has no ``result`` array (an
    error body; only a present, empty array is an empty page), or its window
    or page number is not one. ``run`` names the crawl that landed the page
    (null where the landing has none). The page identity comes from the document when it
    carries one; a bare service body (``{"response": ...}`` only) takes it
    from ``run`` / ``window_start`` / ``page_no`` columns of the input, e.g.
    partition folders ``window_start=.../page_no=.../`` of the landing layout.
    """
    pages = _decoded(text, feed, value, None, ())
    return pages.drop("_raw")


def index_envelopes(text: DataFrame, feed: str | Feed, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The page index: feed, run, window_start, page_no, n_records and
    ``bad_reason`` of every document, its text (``value``) and the ``keep``
    columns. Reads through a document without building any of its records,
    so what pages to take can be decided before they are decoded."""
    pages = _decoded(text, feed, value, SKIPPED, keep)
    return pages.select("feed", "run", "window_start", "page_no", "n_records", "bad_reason", F.col("_raw").alias("value"), *keep)


def identify_envelopes(text: DataFrame, feed: str | Feed, value: str = "value") -> DataFrame:
    """feed, run, window_start and page_no of every document and its text
    (``value``). The response is passed over unread: whether a document is bad
    shows in its index and when it is decoded."""
    f = get_feed(feed) if isinstance(feed, str) else feed
    schema = T.StructType([field for field in envelope_schema(f) if field.name != "response"])
    parsed, run, window, page, _ = _identity(text, f, value, schema, ())
    return parsed.select(F.coalesce(F.col("d.feed"), F.lit(f.name)).alias("feed"), run.alias("run"),
                         F.try_to_date(window).alias("window_start"), page.alias("page_no"), F.col("_raw").alias("value"))


def _identity(text: DataFrame, f: Feed, value: str, schema: T.StructType, keep: Sequence[str]) -> tuple[DataFrame, Column, Column, Column, Column]:
    """(documents read by ``schema`` as ``d``, run, window and page number of
    each, the text its page number was given as outside the document)."""
    doc = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    side = [c for c in ("run", "window_start", "page_no") if c in text.columns]
    parsed = text.select(F.col(value).alias("_raw"), doc.alias("d"), *[F.col(c).alias(f"_path_{c}") for c in side], *keep)
    window, page, run = F.col("d.window_start"), F.col("d.page_no"), F.col("d.run")
    page_text = F.lit(None).cast("string")
    if "run" in side:
        run = F.coalesce(run, F.col("_path_run").cast("string"))
    if "window_start" in side:
        window = F.coalesce(window, F.col("_path_window_start").cast("string"))
    if "page_no" in side:
        page_text = F.col("_path_page_no").cast("string")
        page = F.coalesce(page, page_text.try_cast("bigint"))
    return parsed, run, window, page, page_text


def _decoded(text: DataFrame, feed: str | Feed, value: str, record: T.StructType | None, keep: Sequence[str]) -> DataFrame:
    f = get_feed(feed) if isinstance(feed, str) else feed
    parsed, run, window, page, page_text = _identity(text, f, value, envelope_schema(f, record), keep)
    start = F.try_to_date(window)
    reason = F.when(F.col(f"d.{CORRUPT}").isNotNull() | F.col("d").isNull(), F.lit("malformed page document")).when(
        F.col("d.response.result").isNull(), F.lit("no result array")).when(
        window.isNotNull() & start.isNull(), F.format_string("bad window_start <%s>", window)).when(
        page.isNull(), F.concat(F.lit("bad page_no <"), F.coalesce(page_text, F.lit("")), F.lit(">")))
    return parsed.select(
        F.coalesce(F.col("d.feed"), F.lit(f.name)).alias("feed"),
        run.alias("run"),
        start.alias("window_start"),
        page.alias("page_no"),
        F.col("d.response.result").alias("records"),
        F.size(F.col("d.response.result")).alias("n_records"),
        F.when(reason.isNotNull(), F.col("_raw")).alias(CORRUPT),
        reason.alias("bad_reason"), "_raw", *keep,
    )


def read_envelopes(spark: SparkSession, path: str | Sequence[str], feed: str | Feed,
                   whole_file: bool = False) -> DataFrame:
    """Scan landed page documents (one per line, or one per file)."""
    return parse_envelopes(read_documents(spark, path, whole_file), feed)


def read_documents(spark: SparkSession, path: str | Sequence[str], whole_file: bool = False) -> DataFrame:
    """Landed page documents as text (one per line, or one per file)."""
    reader = spark.read.option("wholetext", "true") if whole_file else spark.read
    return reader.text([path] if isinstance(path, str) else list(path))


def bad_envelopes(pages: DataFrame) -> DataFrame:
    """Bad documents, with the reason (for the rejects table)."""
    return pages.filter(F.col("bad_reason").isNotNull()).select(
        "feed", F.col(CORRUPT).alias("raw"), F.col("bad_reason").alias("reason"))


def good_envelopes(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("bad_reason").isNull())


# -- O2 ----------------------------------------------------------------------
def explode_envelope(pages: DataFrame) -> DataFrame:
    """One row per record: feed, run, window_start, page_no, position, then
    the record's fields. (run, window_start, page_no, position) is the arrival
    order: a later crawl comes after an earlier one."""
    # not a filter, which Spark would push below the decode and decode for once more
    records = F.when(F.col("bad_reason").isNull(), F.col("records"))
    rows = pages.select("feed", "run", "window_start", "page_no", F.posexplode(records).alias("position", "rec"))
    return rows.select("feed", "run", "window_start", "page_no", F.col("position").cast("int"), "rec.*")


# -- landing: the inverse of O1/O2, used for fixtures and round trips ---------
def envelopes_from_pages(paged: DataFrame, feed: str | Feed, window: str = "window_start",
                         terminator: bool = False, run: str | None = None) -> DataFrame:
    """Group records that already carry ``page_no``/``position`` (see
    ``assign_pages``) into page documents. Each page holds a bounded number
    of records, so the per-page ``collect_list`` is bounded. With
    ``terminator`` each window also gets the empty page a crawler stops at."""
    f = get_feed(feed) if isinstance(feed, str) else feed
    fields = [F.col(c) for c in f.source_fields if c in paged.columns]
    pages = paged.groupBy(F.col(window).alias("_win"), "page_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col("position"), F.struct(*fields).alias("rec")))).alias("_recs"))
    pages = pages.select("_win", "page_no", F.transform("_recs", lambda x: x["rec"]).alias("_result"))
    if terminator:
        ends = pages.groupBy("_win").agg((F.max("page_no") + 1).alias("page_no"))
        empty = F.array().cast(pages.schema["_result"].dataType)
        pages = pages.unionByName(ends.select("_win", "page_no", empty.alias("_result")))
    doc = F.to_json(F.struct(
        F.lit(f.name).alias("feed"),
        F.lit(run).cast("string").alias("run"),
        F.col("_win").alias("window_start"),
        F.col("page_no"),
        F.struct(F.col("_result").alias("result")).alias("response"),
    ))
    return pages.select(F.lit(f.name).alias("feed"), F.col("_win").alias("window_start"), "page_no",
                        doc.alias("value"))


def build_envelopes(records: DataFrame, feed: str | Feed, order: Sequence[str | Column],
                    window: str | None = "window_start", size: int = PAGE_SIZE,
                    terminator: bool = False) -> DataFrame:
    """Group records into page documents as the service would serve them:
    pages numbered per window in ``order`` (``assign_pages``), at most
    ``size`` records each."""
    win = F.col(window) if window else F.lit(None).cast("date")
    paged = assign_pages(records.withColumn("_win", win), by=["_win"], order=order, size=size)
    return envelopes_from_pages(paged, feed, window="_win", terminator=terminator)


def land_envelopes(pages: DataFrame, path: str, feed: str | None = None) -> str:
    """Write page documents as JSON Lines text, one folder per feed. Files are
    gzipped (field names recur in every record) and read whole by one task
    each: they are as large as the partitions of ``pages``.

    With ``feed`` only that feed's documents are written, beside those that
    other feeds have landed: no task then sorts its documents by feed.
    """
    if feed is not None:
        pages.where(F.col("feed") == feed).select("value").write.mode("errorifexists").option("compression", "gzip").text(f"{path}/feed={feed}")
        return path
    pages.select("feed", "value").write.mode("errorifexists").option("compression", "gzip").partitionBy("feed").text(path)
    return path
