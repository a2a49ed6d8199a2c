"""The N best items of every group: a hot-cold split by exact group counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peertide.operators.skew import MOST_HEAVY, heavy_keys, with_parts
from peertide.session import durable

#: Names no table has.
PREFIX = "__peertide_"
PARTS, SALT = PREFIX + "parts", PREFIX + "salt"
#: Rows of a group that one sort takes; a group of more is hot.
HEAVY_ROWS = 512


def top_n(
    df: DataFrame, group: list[str], score: str, tie: list[str], n: int, *, heavy_rows: int = HEAVY_ROWS, most_heavy: int = MOST_HEAVY
) -> DataFrame:
    """The rows of df with rank <= n within their group, plus `rank` (1 is best; higher score first, ties by `tie` ascending).

    Exact group counts, combined before their exchange, send groups of more than `heavy_rows` rows to the hot side: their
    rows get a salt (a hash of the row, so a repeated task agrees) out of as many as the group's rows fill, are
    range-partitioned and sorted by (group, salt), and at most n rows of each salt go on to the final ranking. Light groups
    take one ordinary window. Both sides are joined by a union; no row is dropped before it is ranked below n others of
    its own group. A group of 10^9 rows falls into as many parts as any 10^9 rows do.

    What is broadcast is the list of hot groups, at most `most_heavy` whatever the table's size: parts grow with the table
    beyond that. df is read three times (counts, light, hot): hand over a stored table. Null group columns form a group of
    their own; null scores rank last; rows equal in score and tie keep an order by all other columns, so the result is the
    same in every run; fewer than n rows give what there is; an empty table gives no rows. A column named `rank` is
    replaced; helper columns have names of their own.
    """
    df = df.drop("rank")
    rest = sorted(c for c, kind in df.dtypes if c not in (*group, score, *tie) and not kind.startswith("map"))
    order = [F.col(score).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in (*tie, *rest)]]

    def best(d: DataFrame, by: list[str]) -> DataFrame:
        return d.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)

    counts = df.groupBy(*[F.col(c).alias(f"{PREFIX}g{i}") for i, c in enumerate(group)]).agg(F.count(F.lit(1)).alias("n"))
    heavy = heavy_keys(durable(counts), [f"{PREFIX}g{i}" for i in range(len(group))], part_rows=heavy_rows, most_heavy=most_heavy)
    heavy = heavy.select(*[F.col(f"{PREFIX}g{i}").alias(c) for i, c in enumerate(group)], "parts")
    marked = with_parts(df, group, heavy, PARTS)
    cold = best(marked.where(F.col(PARTS) == 1).drop(PARTS), group)
    salted = marked.where(F.col(PARTS) > 1).withColumn(SALT, F.pmod(F.xxhash64(*tie, score, *rest), F.col(PARTS))).drop(PARTS)
    hot = best(best(salted.repartitionByRange(*[F.col(c) for c in group], F.col(SALT)), [*group, SALT]).drop(SALT, "rank"), group)
    return cold.unionByName(hot)


def best_row(df: DataFrame, keys: dict[str, Column], value: str) -> DataFrame:
    """One row per key with its highest value; rows with a null key or value take no part. Combines before the exchange."""
    out = df.select(*[c.alias(k) for k, c in keys.items()], F.col(value)).where(F.col(value).isNotNull())
    for k in keys:
        out = out.where(F.col(k).isNotNull())
    return out.groupBy(*keys).agg(F.max(value).alias(value))
