"""Totals over trailing calendar periods, silent days included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_loaded(df: DataFrame, keys: dict[str, Column], value: Column, loaded: Column) -> DataFrame:
    """One row per key: the value of the row loaded last, a null included; among rows loaded at the same moment the largest
    value wins (null last), so that repeats and ties give one defined result. Combines before the exchange."""
    return (
        df.select(*[c.alias(k) for k, c in keys.items()], value.alias("v"), loaded.alias("l"))
        .groupBy(*keys)
        .agg(F.max(F.struct("l", "v")).alias("last"))
        .select(*keys, F.col("last.v").alias("value"))
    )


def trailing_totals(
    df: DataFrame, entity: Column, day: Column, value: Column, loaded: Column, windows: tuple[int, ...] = (7, 30)
) -> DataFrame:
    """(entity, day, total_<w>, avg_<w> ...) for each calendar day from the entity's first to its last.

    Each daily value is exploded onto every day it influences, the exploded rows are summed by entity and day, and a calendar
    of the entity's life is joined for the days nothing fell on. Averages divide by the length of the window.

    Everything after the first aggregation runs on one hash partitioning by entity: an entity then has at most one row per
    calendar day, so a hot entity is bounded by the calendar and not by its rows.

    Rows without entity or day take no part; null values add nothing but their day exists; of several rows for a day the last
    loaded counts; an empty table gives no rows.
    """
    daily = (
        last_loaded(df.where(entity.isNotNull() & day.isNotNull()), {"entity": entity, "day": day}, value, loaded)
        .repartition("entity")
    )
    longest = max(windows)
    reach = (
        daily.where(F.col("value") != 0)
        .select("entity", "day", "value", F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("lag"))
        .select("entity", F.date_add("day", F.col("lag")).alias("day"), "value", "lag")
        .groupBy("entity", "day")
        .agg(*[F.sum(F.when(F.col("lag") < w, F.col("value"))).alias(f"total_{w}") for w in windows])
    )
    life = daily.groupBy("entity").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = life.select("entity", F.explode(F.sequence("first", "last")).alias("day"))
    out = calendar.join(reach, ["entity", "day"], "left")
    cols = []
    for w in windows:
        total = F.coalesce(F.col(f"total_{w}"), F.lit(0)).cast("bigint")
        cols += [total.alias(f"total_{w}"), (total / F.lit(float(w))).alias(f"avg_{w}")]
    return out.select("entity", "day", *cols)
