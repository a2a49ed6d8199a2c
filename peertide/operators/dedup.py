"""First-wins choices, upserts as views over append-only rows, retention and cascades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: list[str], order: list[Column], keep: list[str] | None = None) -> DataFrame:
    """The first row of each key in a total order: a minimum over structs, combined before the exchange, no sort of groups.
    Ties are settled by the kept columns themselves."""
    keep = keep or [c for c in df.columns if c not in key]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c).isNull().alias(f"n_{c}") for c in keep], *[F.col(c) for c in keep])
    return df.groupBy(*key).agg(F.min(rank).alias("w")).select(*key, *[F.col("w")[c].alias(c) for c in keep])


def latest_view(df: DataFrame, key: list[str]) -> DataFrame:
    """The state of a (hash, ip) upsert that keeps first_seen, moves last_seen forward and takes the country of the latest
    sighting; a replay with an older day changes nothing."""
    newest = F.struct(F.col("last_seen").alias("d"), F.col("ingested_at").alias("t"), F.col("country").alias("c"))
    return df.groupBy(*key).agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max(F.when(F.col("last_seen").isNotNull() & F.col("country").isNotNull(), newest)).alias("w"),
    ).select(*key, "first_seen", "last_seen", F.col("w.c").alias("country"))


def keep_country_view(df: DataFrame, key: list[str]) -> DataFrame:
    """The upsert that moves last_seen only: the country of the first sighting stays."""
    oldest = F.struct(F.col("first_seen").alias("d"), F.col("ingested_at").alias("t"), F.col("country").alias("c"))
    return df.groupBy(*key).agg(
        F.max("last_seen").alias("last_seen"),
        F.min(F.when(F.col("first_seen").isNotNull() & F.col("country").isNotNull(), oldest)).alias("w"),
    ).select(*key, "last_seen", F.col("w.c").alias("country"))


def merge_upsert(old: DataFrame, new: DataFrame, key: list[str], rules: dict[str, str]) -> DataFrame:
    """Full outer merge of two tables with unique keys. Rules per column: `max`, `fill` (old unless null or blank), `replace` (new
    unless null), `union` (sorted union of arrays)."""
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key]
    out = [F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in key]
    for c, rule in rules.items():
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if rule == "max":
            e = F.greatest(a, b)
        elif rule == "fill":
            e = F.coalesce(F.nullif(a, F.lit("")), b)
        elif rule == "replace":
            e = F.coalesce(b, a)
        else:
            empty = F.array().cast("array<string>")
            e = F.array_sort(F.array_union(F.coalesce(a, empty), F.coalesce(b, empty)))
        out.append(e.alias(c))
    return o.join(n, on, "full").select(*out)


def update_if_better(old: DataFrame, new: DataFrame, key: str, measure: str, together: list[str]) -> DataFrame:
    """The measure and its companions change only where the new measure is larger; new keys are added."""
    better = F.col(f"n.{measure}") > F.coalesce(F.col(f"o.{measure}"), F.lit(0))
    take = F.col(f"o.{key}").isNull() | F.coalesce(better, F.lit(False))
    cols = [F.when(take, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in (measure, *together)]
    return old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *cols)


def insert_ignore(target: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of new whose key the target lacks, one per key."""
    return first_wins(new.join(target.select(*key), key, "left_anti"), key, [F.lit(0)])


def retain(df: DataFrame, day: str, as_of: Column, days: int) -> DataFrame:
    """Rows at most `days` days old; on a table partitioned by day this prunes whole partitions."""
    return df.where(F.col(day) >= F.date_sub(as_of, days))


def remap(df: DataFrame, mapping: DataFrame, column: str, *, most: int) -> tuple[DataFrame, DataFrame]:
    """(df with `column` replaced along mapping(old, new), the changed rows as they were). Refuses mappings that change more
    than `most` rows, before anything is written."""
    m = mapping.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    joined = df.join(m, F.col(column) == F.col("_old"), "left")
    before = joined.where("_new is not null").drop("_old", "_new")
    n = before.count()
    if n > most:
        raise ValueError(f"the mapping would change {n} rows; at most {most} are allowed")
    return joined.withColumn(column, F.coalesce("_new", column)).drop("_old", "_new"), before
