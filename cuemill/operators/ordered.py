"""Neighbours and running values along an order inside keys, when one key may hold a large part of all rows.

A plain window per key puts a key's rows into one task. Here the rows of a key are cut into chunks of the order column;
windows run inside chunks, and what crosses a chunk's edge comes from one summary row per chunk.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1024


def settled(df: DataFrame) -> DataFrame:
    """The frame written to the session's shared checkpoint folder: plans that read it several times compute it once, and a lost executor costs a read. A local folder is set only where the session names none."""
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cuemill-"))
    return df.checkpoint()


def _chunked(df: DataFrame, order: str, size: int) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.col(order) / size).cast("bigint"))


def with_previous(df: DataFrame, keys: list[str], order: str, fields: list[str], name: str = "previous", size: int = CHUNK) -> DataFrame:
    """Adds the struct of the fields of the row before in the order (null for a key's first). ``order`` is a whole number, unique inside a key."""
    rows = _chunked(df, order, size)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    own = rows.withColumn("_lag", F.lag(F.struct(*fields)).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    last = rows.groupBy(*keys, "_chunk").agg(F.max_by(F.struct(*fields), order).alias("_last"))
    edge = last.withColumn("_edge", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk"))).drop("_last")
    joined = own.join(edge, [*keys, "_chunk"])
    return joined.withColumn(name, F.when(F.col("_first"), F.col("_edge")).otherwise(F.col("_lag"))).drop("_lag", "_first", "_edge", "_chunk")


def with_next(df: DataFrame, keys: list[str], order: str, fields: list[str], name: str = "next", size: int = CHUNK) -> DataFrame:
    turned = df.withColumn("_back", -F.col(order))
    return with_previous(turned, keys, "_back", fields, name, size).drop("_back")


def with_running_sum(df: DataFrame, keys: list[str], order: str, value: Column, name: str, size: int = CHUNK) -> DataFrame:
    """Adds the sum of the value over the rows up to and with this one."""
    rows = _chunked(df.withColumn("_value", value), order, size)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("_sum", F.sum("_value").over(inside))
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_total"))
    before = totals.withColumn("_before", F.coalesce(F.sum("_total").over(Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_total")
    return own.join(before, [*keys, "_chunk"]).withColumn(name, F.col("_before") + F.col("_sum")).drop("_sum", "_before", "_value", "_chunk")


def ranks(df: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """Adds the place (from 1) of each row inside its key, in an order of any columns.

    The rows are sorted by ranges over all tasks, so that a key of any size is spread; what a task needs of the others
    is how many rows they hold, and where each key begins is one small row per key."""
    named = df.withColumns({f"_o{k}": c for k, c in enumerate(order)})
    by = [*keys, *[f"_o{k}" for k in range(len(order))]]
    # written once: a second reading of a range partitioning could cut it elsewhere
    rows = settled(named.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() % F.lit(1 << 33)))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    placed = rows.join(F.broadcast(before), "_part").withColumn("_place", F.col("_before") + F.col("_at"))
    first = placed.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("_place").alias("_first"))
    joined = placed.join(first, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return joined.select(*df.columns, (F.col("_place") - F.col("_first") + 1).cast("bigint").alias(name))


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key, the greatest in ``by``: an aggregation that combines before it shuffles, not a sort of each key's rows."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
