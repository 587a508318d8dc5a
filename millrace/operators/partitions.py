"""Queries and transitions of partition metadata.

Metadata is a log of transitions: every write appends rows with a version, and the newest version of a token is its current row. Children that are
found again (a merge reports its child once per parent) keep the first row written.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schemas import CREATED, FINISHED, METADATA, ROOT_TOKEN, RUNNING, SCHEDULED

FIELDS = [f.name for f in METADATA.fields]


def current(log: DataFrame, version: str = "version") -> DataFrame:
    """The newest row of each token; the rest of the log combines before the shuffle."""
    names = [c for c in log.columns if c not in (version, "partition_token")]
    return log.groupBy("partition_token").agg(F.max_by(F.struct(*names), version).alias("_r")).select("partition_token", *(F.col(f"_r.{n}").alias(n) for n in names))


def root_token(token: Column) -> Column:
    """The token that the stream is asked for: null for the first partition."""
    return F.nullif(token, F.lit(ROOT_TOKEN))


def is_root(token: Column) -> Column:
    return F.coalesce(token == ROOT_TOKEN, F.lit(False))


def unfinished(meta: DataFrame) -> DataFrame:
    return meta.where(F.col("state") != FINISHED)


def min_watermark(meta: DataFrame) -> DataFrame:
    """The unfinished partition with the least watermark (and token); no row when all are finished."""
    return unfinished(meta).orderBy("watermark", "partition_token").limit(1)


def interrupted(meta: DataFrame) -> DataFrame:
    """Partitions that were read when the last run ended, by watermark."""
    return meta.where(F.col("state").isin(SCHEDULED, RUNNING)).orderBy("watermark", "partition_token")


def schedulable(meta: DataFrame, low: datetime | None = None, strict_parents: bool = False) -> DataFrame:
    """Created partitions that start at ``low`` or later (the least unfinished watermark if not given), by start.

    That bound excludes none on a consistent snapshot; ``strict_parents`` also waits until every known parent is finished.
    """
    bound = F.lit(low).cast(meta.schema["watermark"].dataType) if low is not None else None
    if bound is None:
        least = unfinished(meta).agg(F.min("watermark").alias("_low"))
        rows = meta.where(F.col("state") == CREATED).join(F.broadcast(least)).where(F.col("start_timestamp") >= F.col("_low")).drop("_low")  # one row
    else:
        rows = meta.where((F.col("state") == CREATED) & (F.col("start_timestamp") >= bound))
    if strict_parents:
        open_ = unfinished(meta).select(F.col("partition_token").alias("_parent"))
        waits = rows.select("partition_token", F.explode("parent_tokens").alias("_parent")).join(open_, "_parent", "left_semi").select("partition_token").distinct()
        rows = rows.join(waits, "partition_token", "left_anti")
    return rows.orderBy("start_timestamp", "partition_token")


def to_start(meta: DataFrame, active: DataFrame) -> DataFrame:
    """Partitions without a reader that is active already."""
    return meta.join(active.select("partition_token"), "partition_token", "left_anti")


def transition(meta: DataFrame, tokens: Column, state: str, at: Column) -> DataFrame:
    """``meta`` with the chosen rows in a state, and the time of that; watermarks stay as they are."""
    stamp = {SCHEDULED: "scheduled_at", RUNNING: "running_at", FINISHED: "finished_at"}[state]
    return meta.withColumns({"state": F.when(tokens, F.lit(state)).otherwise(F.col("state")), stamp: F.when(tokens, at).otherwise(F.col(stamp))})


def with_watermark(meta: DataFrame, token: str, watermark: Column) -> DataFrame:
    """``meta`` with a partition's new watermark, whatever the old one was."""
    return meta.withColumn("watermark", F.when(F.col("partition_token") == token, watermark).otherwise(F.col("watermark")))


def root(spark, start: Column, end: Column, heartbeat_millis: int, now: Column) -> DataFrame:
    """The row of the first partition; writing it again resets it."""
    none = F.lit(None).cast("timestamp")
    return spark.range(1).select(
        F.lit(ROOT_TOKEN).alias("partition_token"), F.array().cast("array<string>").alias("parent_tokens"), start.alias("start_timestamp"), end.alias("end_timestamp"),
        F.lit(heartbeat_millis).cast("bigint").alias("heartbeat_millis"), F.lit(CREATED).alias("state"), start.alias("watermark"), now.alias("created_at"),
        none.alias("scheduled_at"), none.alias("running_at"), none.alias("finished_at"),
    )


def first_children(children: DataFrame, order: list[str]) -> DataFrame:
    """Of each child token, the row found first; ``children`` has token, parent_tokens, start_timestamp and the order's columns."""
    names = [c for c in children.columns if c not in ("token", *order)]
    first = children.groupBy("token").agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_r"))
    return first.select("token", *(F.col(f"_r.{n}").alias(n) for n in names))


def new_children(children: DataFrame, known: DataFrame, end: Column, heartbeat_millis: Column, now: Column, order: list[str]) -> DataFrame:
    """Metadata rows of children that aren't known yet; end and heartbeat are the reader's, the watermark is the start."""
    none = F.lit(None).cast("timestamp")
    rows = first_children(children, order).join(known.select(F.col("partition_token").alias("token")), "token", "left_anti")
    return rows.select(
        F.col("token").alias("partition_token"), "parent_tokens", "start_timestamp", end.alias("end_timestamp"), heartbeat_millis.cast("bigint").alias("heartbeat_millis"),
        F.lit(CREATED).alias("state"), F.col("start_timestamp").alias("watermark"), now.alias("created_at"), none.alias("scheduled_at"), none.alias("running_at"), none.alias("finished_at"),
    )


def retained(meta: DataFrame, now: Column, days: int = 1) -> DataFrame:
    """``meta`` without partitions that finished so many days ago or earlier."""
    return meta.where(F.col("finished_at").isNull() | (F.col("finished_at") >= now - F.expr(f"INTERVAL {days} DAY")))
