"""Resume positions from acknowledgements.

A partition's records have a read order. The acknowledged prefix ends before the first record that isn't acknowledged; the resume position is the
timestamp of the prefix's last record, not the greatest timestamp. Heartbeats and child records count as acknowledged at once, but
wait behind earlier data records.

Nothing here sorts a whole partition: the first gap is the least read position that isn't acknowledged, and the rest are aggregates that
combine before the shuffle, so a partition of any size costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ack_watermark(log: DataFrame, by: list[str], order: list[str], ts: str = "ts", acked: Column | None = None) -> DataFrame:
    """(by, first_gap, n_acked, watermark) of each partition; first_gap is null without a gap, watermark is null with an empty prefix."""
    done = F.coalesce(acked if acked is not None else F.col("acked"), F.lit(False))
    at = F.struct(*order)
    rows = log.select(*by, F.col(ts).alias("_ts"), at.alias("_at"), done.alias("_done"))
    gap = rows.groupBy(*by).agg(F.min(F.when(~F.col("_done"), F.col("_at"))).alias("_gap"))
    inside = F.col("_gap").isNull() | (F.col("_at") < F.col("_gap"))
    joined = rows.join(gap, by)
    n = F.sum(F.when(inside, 1).otherwise(0)).cast("long")
    out = joined.groupBy(*by).agg(n.alias("n_acked"), F.max_by("_ts", F.when(inside, F.col("_at"))).alias("watermark"), F.max(F.col("_gap").isNotNull()).alias("_has"))
    return out.select(*by, F.when(F.col("_has"), F.col("n_acked")).alias("first_gap"), "n_acked", "watermark")


def sequenced(log: DataFrame, by: list[str], order: list[str], bucket: Column, name: str = "seq") -> DataFrame:
    """``log`` with each record's number, from 0, in its partition's read order.

    ``bucket`` must not decrease along the order. Numbers are counted inside (partition, bucket) and moved by the sizes of earlier buckets, so the
    largest sort is a bucket of a partition, not a partition.
    """
    rows = log.withColumn("_bucket", bucket)  # small buckets keep sorts small, as the sizes of all buckets are far fewer rows than the log
    sizes = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    number = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(*order)) - 1
    return rows.withColumn("_row", number).join(before, [*by, "_bucket"]).withColumn(name, (F.col("_row") + F.col("_before")).cast("long")).drop("_bucket", "_row", "_before")


def resumed(log: DataFrame, positions: DataFrame, by: list[str], ts: str = "ts", watermark: str = "watermark") -> DataFrame:
    """What is read again after a restart: everything at or after a partition's resume position, all of it where there is none."""
    return log.join(positions.select(*by, F.col(watermark).alias("_from")), by, "left").where(F.col("_from").isNull() | (F.col(ts) >= F.col("_from"))).drop("_from")


def admitted(log: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` records of each partition: what one micro-batch may have in flight."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return log.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")
