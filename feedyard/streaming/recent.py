"""De-duplication of a stream in bounded state, late rows kept apart (O43).

Adjacent windows share a boundary day, so a crawl delivers the records of that
day twice, soon after each other. ``split_recent`` keeps the first delivery of
every key and remembers a key only until the watermark has passed its event
time by ``delay``; ``stream_dedupe_recent`` writes what is kept to a keyed
table and what came behind the watermark to a table of late rows, so nothing
is lost silently.

The keys are hashed to groups, and the state store holds, per group, the
hashes and event times of its recent keys. They are compared in whole batches
(numpy), and a group drops what the watermark has passed whenever rows reach
it, so what a group remembers is younger than two delays (and the step of the
watermark) at its last visit. No timers run and no key is an entry of its own.

A row counts as late if its event time lies before the watermark of its
micro-batch (the highest event time of earlier micro-batches less ``delay``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

from feedyard.sinks.table import VersionedTable

#: Groups that keys are hashed to: many more than tasks, so none is large.
GROUPS = 1024
STATE = "first array<long>, second array<long>, until array<long>"
#: Helper columns: hashes of the key and of the row, event time (microseconds), group.
HELPERS = ("_h1", "_h2", "_h3", "_us", "_group")


def _judge(delay_us: int, passed: list[str], after: list[str]):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        first, second, until = (np.array(x or [], np.int64) for x in (state.get if state.exists else ((), (), ())))
        live = until >= mark
        known = dict(zip(zip(first[live].tolist(), second[live].tolist()), until[live].tolist()))
        for batch in batches:
            us = batch["_us"].to_numpy(np.int64)
            late = us < mark
            keep = np.zeros(len(batch), bool)
            # the first delivery of a key in event order, then by the other columns
            order = np.lexsort((batch["_h3"].to_numpy(np.int64), us))
            for k, h1, h2, at in zip(order, batch["_h1"].to_numpy()[order].tolist(), batch["_h2"].to_numpy()[order].tolist(), us[order].tolist()):
                if not late[k] and (h1, h2) not in known:
                    keep[k] = True
                    known[h1, h2] = at + delay_us
            if (keep | late).any():
                out = batch.loc[keep | late, passed].copy()
                out["late"] = late[keep | late]
                yield out[after]
        if known:
            h1, h2 = zip(*known)
            state.update((list(h1), list(h2), list(known.values())))
        elif state.exists:
            state.remove()

    return run


def split_recent(df: DataFrame, keys: Sequence[str], event_time: str, delay: str, groups: int = GROUPS) -> DataFrame:
    """The rows of a stream that are first deliveries of their key, and the
    late ones, told apart by the column ``late``.

    ``delay`` is an interval ('2 days'): deliveries of one key lie closer
    together than that. Null keys are values like any other; rows without an
    event time cannot be late or expire and are refused (``late`` is true).
    Several first deliveries of a key in one micro-batch: the earliest event
    time stays. The event-time column becomes a ``TIMESTAMP`` (watermarks
    take no ``TIMESTAMP_NTZ``).
    """
    taken = {c.lower() for c in df.columns} & {*HELPERS, "late"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are used here")
    spark = df.sparkSession
    micros = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {delay}")).alias("us"))
    delay_us = int(micros.first().us)
    at = F.col(event_time).cast("timestamp")
    given = df.withColumn(event_time, at)
    h = [F.xxhash64(F.lit(n), *[F.struct(F.col(k)) for k in keys]) for n in (1, 2)]
    marked = given.withWatermark(event_time, delay).withColumns({
        "_h1": h[0], "_h2": h[1], "_h3": F.xxhash64(*given.columns),
        "_us": F.coalesce(F.unix_micros(event_time), F.lit(-(1 << 62))), "_group": F.pmod(h[0], F.lit(int(groups))),
    })
    after = StructType([*given.schema.fields, StructField("late", BooleanType())])
    return marked.groupBy("_group").applyInPandasWithState(
        _judge(delay_us, given.columns, after.names), after, STATE, "append", GroupStateTimeout.NoTimeout)


def stream_dedupe_recent(df: DataFrame, keys: Sequence[str], event_time: str, delay: str, table: VersionedTable, late_dir: str,
                         checkpoint: str, groups: int = GROUPS, available_now: bool = True,
                         query_name: str = "dedupe_recent") -> StreamingQuery:
    """Write first deliveries into ``table`` and late rows under ``late_dir``.

    Exactly once: the table records the micro-batches it has taken, and a
    micro-batch's late rows are one folder, overwritten on replay.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        # two writes of one stateful result: judge it once
        judged = batch.persist()
        try:
            table.publish(judged.where("not late").drop("late"), order=[event_time], mode="keep", stream_mark=(query_name, batch_id))
            judged.where("late").drop("late").write.mode("overwrite").parquet(f"{late_dir}/batch_id={batch_id}")
        finally:
            judged.unpersist()

    split = split_recent(df, keys, event_time, delay, groups)
    writer = split.writeStream.queryName(query_name).option("checkpointLocation", checkpoint).foreachBatch(publish)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
