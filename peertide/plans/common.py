"""What the query modules share: cleaned tables in Spark and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peertide.functions.ids import is_observer, norm_country, norm_id
from peertide.operators.dedup import first_wins
from peertide.operators.rolling import last_loaded
from peertide.session import table

#: The day the queries of the moment are asked on; always an argument of operators, never the clock.
AS_OF = "2026-04-19"

BRIDGE_COLUMNS = ["ip_id", "title", "category", "seeders", "raw_name", "imdb_id"]


def observations(spark: SparkSession, d: str) -> DataFrame:
    """peers without markers, hash in lower case, country normalised."""
    p = table(spark, d, "peers").where(is_observer("ip"))
    return p.withColumn("hash", F.lower("hash")).withColumn("country", norm_country("country"))


def bridge(spark: SparkSession, d: str) -> DataFrame:
    """One row per hash: the one with most seeders, then by source."""
    h = table(spark, d, "hashes").select("hash", "source", *BRIDGE_COLUMNS).withColumn("ip_id", norm_id("ip_id"))
    return first_wins(h, ["hash"], [-F.coalesce(F.col("seeders"), F.lit(-1)), F.col("source")], BRIDGE_COLUMNS)


def daily(spark: SparkSession, d: str) -> DataFrame:
    """title_demand as one row per title and day: (ip_id, date, value), the last load of each."""
    t = table(spark, d, "title_demand").where("ip_id is not null and date is not null")
    out = last_loaded(t, {"ip_id": norm_id("ip_id"), "date": F.col("date")}, F.col("ip_count"), F.col("loaded_at"))
    return out.where("value >= 0 and value <= 50000000")


def weekly(spark: SparkSession, d: str) -> DataFrame:
    """title_country as one row per date, country and title with the highest count, known countries only."""
    t = table(spark, d, "title_country").withColumn("country", norm_country("country")).withColumn("ip_id", norm_id("ip_id"))
    t = t.where("country is not null and ip_id is not null and ip_count is not null")
    return t.groupBy("date", "country", "ip_id").agg(F.max("ip_count").alias("ip_count"), F.max("category").alias("category"), F.min("title").alias("title"))


_WS = "E' \\t\\n\\r'"
NORM_ID = f"lower(trim(ip_id, {_WS}))"
UP = f"upper(trim(country, {_WS}))"
COUNTRY = f"case when {UP} not in ('', 'XX', '??', 'OTHER') then {UP} end"
OBS = f"""obs as (select lower(hash) as hash, ip, {COUNTRY} as country, first_seen, last_seen, src, ingested_at from peers
  where not (starts_with(ip, '_queried_') or starts_with(ip, '_marker_')))"""
BRIDGE = f"""bridge as (select hash, ip_id, title, category, seeders, raw_name, imdb_id from (select *, row_number() over (partition by hash
  order by coalesce(seeders, -1) desc, source, {", ".join(f"{c} is null, {c}" for c in BRIDGE_COLUMNS)}) as rn
  from (select hash, source, {NORM_ID} as ip_id, title, category, seeders, raw_name, imdb_id from hashes)) where rn = 1)"""
DAILY = f"""daily as (select ip_id, date, v as value from (select {NORM_ID} as ip_id, date, ip_count as v, row_number() over (partition by {NORM_ID}, date
  order by loaded_at desc, ip_count desc nulls last) as rn from title_demand where ip_id is not null and date is not null)
  where rn = 1 and v >= 0 and v <= 50000000)"""
WEEKLY = f"""weekly as (select date, {COUNTRY} as country, {NORM_ID} as ip_id, max(ip_count) as ip_count, max(category) as category, min(title) as title
  from title_country where {COUNTRY} is not null and ip_id is not null and ip_count is not null group by 1, 2, 3)"""
