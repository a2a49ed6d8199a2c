"""Writers: partitioned tables, replaced days, guarded and ordered files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from peertide.sources.feeds import exists


def write_days(df: DataFrame, path: str, day: str = "date", codec: str = "zstd") -> None:
    """Replaces exactly the days that df holds. Rows of one day go to few files: the exchange is by day and a hash of the row, so
    a large day is not one task's work."""
    cols = [c for c in df.columns if c != day]
    n = f"pmod(xxhash64({', '.join(f'`{c}`' for c in cols)}), 8)"
    out = df.selectExpr("*", f"{n} as _part").repartition(day, "_part").drop("_part")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy(day).parquet(path)


def guard_past(spark, path: str, day: str, as_of: str, force: bool = False) -> None:
    """Refuses to write a day before as_of that exists: past days of an upserted table have lost rows since."""
    if date.fromisoformat(day) < date.fromisoformat(as_of) and not force and exists(spark, path):
        raise PermissionError(f"{day} is past and {path} exists")


def ordered_csv(df: DataFrame, path: str, order: list, columns: list[str]) -> None:
    """A small ordered export as one CSV with a header."""
    df.select(*columns).orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def backup_json(df: DataFrame, path: str) -> None:
    """Rows as they were before a mutation."""
    df.write.mode("errorifexists").json(path)


def marker_stub(df: DataFrame, as_of: str, days: int = 5) -> DataFrame:
    """One synthetic row per hash and country active in the last days: no address leaves."""
    active = df.where(f"last_seen >= date_sub(date '{as_of}', {days})")
    return active.groupBy("hash", "country").agg({"last_seen": "max"}).selectExpr("hash", "concat('_marker_', coalesce(country, 'XX')) as ip", "country", "`max(last_seen)` as last_seen")
