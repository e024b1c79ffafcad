"""One key holding a third of all rows: results stay whole and exact, and the
plans combine the hot key before the shuffle."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from feedyard.operators.paging import row_numbers
from feedyard.operators.upsert import reduce_batch, reject_duplicates, upsert
from feedyard.sources.fixtures import table


ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]  # total order


def _hot_batch(spark):
    li = table(spark, SF_SMALL, "lineitem")
    n = li.count()
    hot = F.col("l_orderkey") % 3 == 0  # about a third of the rows share one key
    key = F.when(hot, F.lit("HOT")).otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return li.select(key.alias("k"), F.col("l_partkey").alias("v"), *ORDER), n


def test_hot_key_upsert_is_exact(spark):
    batch, n = _hot_batch(spark)
    rows = batch.collect()
    last = {}
    for r in sorted(rows, key=lambda r: tuple(r[c] for c in ORDER)):
        last[r.k] = r.v
    target = batch.limit(0).unionByName(spark.createDataFrame(
        [("HOT", -1), ("none", -2)], "k string, v bigint"), allowMissingColumns=True)
    out = {r.k: r.v for r in upsert(target, batch, ["k"], ORDER).collect()}
    assert out.pop("none") == -2
    assert out == last
    hot_rows = sum(1 for r in rows if r.k == "HOT")
    assert hot_rows > n / 4
    rej = reject_duplicates(target, batch, ["k"], ORDER)
    assert rej.filter(F.col("k") == "HOT").count() == hot_rows  # every hot row refused, none dropped


def test_reduction_is_partial_before_shuffle(spark):
    batch, _ = _hot_batch(spark)
    plan = reduce_batch(batch, ["k"], ORDER)._jdf.queryExecution().executedPlan().toString()
    # the top row per key of each task, then the exchange, then the final top row
    assert "SortAggregate" not in plan
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial and plan.index(partial[0]) > plan.index("Exchange hashpartitioning(k")


def test_replace_has_two_exchanges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch, _ = _hot_batch(spark)
        plan = upsert(batch.limit(0), batch, ["k"], ORDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 2 and "SortAggregate" not in plan


def test_hot_group_row_numbers(spark):
    li = table(spark, SF_SMALL, "lineitem").withColumn("g", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(
        F.col("l_orderkey") % 7 + 1))
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    rn = row_numbers(li, ["g"], order, num_partitions=6)
    from pyspark.sql import Window
    ref = li.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    joined = rn.join(ref.select(*order, "ref"), on=order)
    assert joined.count() == li.count()
    assert joined.filter(F.col("rn") != F.col("ref")).count() == 0
