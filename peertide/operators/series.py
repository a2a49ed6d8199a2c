"""Dense series, deltas, surges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_delta(df: DataFrame, key: list[str], day: str, measure: str) -> DataFrame:
    """Change against calendar yesterday, a missing yesterday counting as 0. The previous day is a shifted copy with one row per
    key, which the aggregation guarantees, so the join cannot fan out."""
    today = df.groupBy(*key, day).agg(F.sum(measure).alias(measure))
    before = today.select(*key, F.date_add(day, 1).alias(day), F.col(measure).alias("previous"))
    prev = F.coalesce("previous", F.lit(0))
    return today.join(before, [*key, day], "left").select(*key, day, measure, prev.alias("previous"), (F.coalesce(measure, F.lit(0)) - prev).alias("delta"))


def dense(df: DataFrame, key: str, day: str, measure: str, last: int) -> DataFrame:
    """(key, series): the measure on each of the last `last` days present in df, 0 where missing, as one array. The axis is one
    small row joined to the keys, not a product of keys and days that is then joined."""
    daily = df.groupBy(key, day).agg(F.sum(F.coalesce(measure, F.lit(0))).alias("v"))
    axis = df.select(day).distinct().orderBy(F.desc(day)).limit(last).agg(F.array_sort(F.collect_list(day)).alias("axis"))
    per = daily.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(day, "v"))).alias("m"))
    value = F.transform("axis", lambda d: F.coalesce(F.element_at(F.col("m"), d), F.lit(0)))
    return per.join(F.broadcast(axis)).select(key, value.alias("series"))  # the axis is one row


def trailing_mean(df: DataFrame, key: list[str], day: str, measure: str, days: int) -> DataFrame:
    """df with the mean of the `days` previous rows of its key."""
    w = Window.partitionBy(*key).orderBy(day).rowsBetween(-days, -1)
    return df.withColumn(f"avg{days}", F.avg(measure).over(w))


def half_change(series: Column, n: int) -> Column:
    """Mean of the last h values against the h before, h = min(7, n // 2), in percent; 100 where the earlier mean is 0 and the
    later is not, null where both are."""
    h = min(7, n // 2)

    def mean(start: int) -> Column:
        return F.aggregate(F.slice(series, start, h), F.lit(0.0), lambda a, x: a + x) / h

    now, prior = mean(n - h + 1), mean(n - 2 * h + 1)
    return F.when(prior > 0, (now - prior) / prior * 100).when(now > 0, F.lit(100.0))
