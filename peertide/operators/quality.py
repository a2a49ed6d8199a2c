"""Checks of the data: decoys, spikes, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decoys(df: DataFrame, key: str, name: str, *, least: int = 5, repeated: int = 4, share: float = 0.5) -> DataFrame:
    """Keys whose many rows carry few distinct names: at least `least` rows, one name `repeated` times, and distinct names under
    `share` of the rows."""
    n = df.where(F.col(key).isNotNull() & F.col(name).isNotNull()).groupBy(key, name).agg(F.count(F.lit(1)).alias("n"))
    g = n.groupBy(key).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_names"), F.max("n").alias("n_top"))
    return g.where((F.col("n_rows") >= least) & (F.col("n_top") >= repeated) & (F.col("n_names") / F.col("n_rows") < share))


def spikes(delta: DataFrame, key: str, *, least: int = 100, rise: float = 0.5, top: int = 20) -> DataFrame:
    """Keys that rose: rows of at least `least` with a positive delta are summed per key, then keys that rose by `rise` of their
    previous value, the `top` largest first. Filtering rows before the sum keeps small and shrinking parts from diluting it."""
    g = delta.where((F.col("value") >= least) & (F.col("delta") > 0)).groupBy(key).agg(F.sum("value").alias("value"), F.sum("delta").alias("delta"), F.sum("previous").alias("previous"))
    pct = F.when(F.col("previous") > 0, F.col("delta") / F.col("previous"))
    return g.withColumn("pct", pct).where("pct >= %s" % rise).orderBy(F.desc("delta"), key).limit(top)


def health(df: DataFrame, day: str, as_of: Column, *, least: int) -> DataFrame:
    """One row per check with its value and whether it holds: rows of the day, newest day, keys without null."""
    v = df.agg(F.count_if(F.col(day) == as_of).alias("rows_today"), F.max(day).alias("newest"), F.count_if(F.col(day).isNull()).alias("undated"))
    checks = F.array(
        F.struct(F.lit("rows_today").alias("name"), F.col("rows_today").cast("string").alias("value"), (F.col("rows_today") >= least).alias("ok")),
        F.struct(F.lit("newest").alias("name"), F.col("newest").cast("string").alias("value"), (F.col("newest") >= as_of).alias("ok")),
        F.struct(F.lit("undated").alias("name"), F.col("undated").cast("string").alias("value"), (F.col("undated") == 0).alias("ok")),
    )
    return v.select(F.explode(checks).alias("c")).select("c.*")
