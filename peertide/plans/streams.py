"""Queries stm*, src02, skt: streams run to their end over a table, and tolerant reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from peertide.functions.ids import is_observer, norm_country
from peertide.operators.dedup import latest_view
from peertide.plans.common import AS_OF, BRIDGE, OBS, bridge, observations
from peertide.plans.relational import ORACLE as RELATIONAL
from peertide.session import scratch, ship, table
from peertide.sources import feeds
from peertide.streaming import announce


def _stream(spark: SparkSession, d: str) -> DataFrame:
    ship(spark)
    path = f"{d}/peers.parquet"
    schema = spark.read.parquet(path).schema
    folder = feeds.exists(spark, f"{path}/*.parquet")
    s = spark.readStream.schema(schema).parquet(path if folder else f"{d}/peers.parque[t]")  # a single file is read by a pattern
    s = s.where(is_observer("ip")).withColumn("hash", F.lower("hash")).withColumn("country", F.coalesce(norm_country("country"), F.lit("??")))
    return s.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))


def _drain(df: DataFrame, mode: str, key: list[str] | None = None) -> DataFrame:
    """Runs a stream over what is there now and returns its output as a table: of updated rows the last state of each key."""
    spark = df.sparkSession
    base = scratch(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    q = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.schema(StructType([*df.schema.fields, StructField("batch", IntegerType())])).parquet(f"{base}/out")
    if mode != "update":
        return out.drop("batch")
    rest = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*rest), "batch").alias("m")
    return out.groupBy(*key).agg(newest).select(*key, "m.*")


def stm01_stream_dedup(spark, d):
    """Distinct observers per day, hash and country, counted by a stream."""
    return _drain(announce.daily_distinct(_stream(spark, d), late="2 days"), "update", ["day", "hash", "country"])


def stm03_state_last_seen(spark, d):
    """State of (hash, ip) after the stream, from states that end with their day."""
    return announce.settled_last_seen(_drain(announce.last_seen_state(_stream(spark, d)), "update", ["day", "hash", "ip"]))


def stm04_retention(spark, d):
    """Pairs of hash and observer, each once while it is remembered."""
    return _drain(announce.first_in_retention(_stream(spark, d), ["hash", "ip"]).select("hash", "ip"), "append")


def stm06_resume(spark, d):
    """The worklist of a run that starts again: hashes without a row of the day."""
    done = table(spark, d, "peers").where(F.col("last_seen") == F.lit(AS_OF).cast("date")).select(F.lower("hash").alias("hash"))
    return bridge(spark, d).select("hash", "seeders").join(done, "hash", "left_anti")


def stm08_hot_lane(spark, d):
    """Observations of the hot set (at least 200 seeders), a lane of its own: the stream meets the set as it is when a batch starts."""
    hot = bridge(spark, d).where("seeders >= 200").select("hash")
    s = _stream(spark, d).join(hot, "hash", "left_semi").withWatermark("ingested_at", "2 days")
    g = s.groupBy(F.window("ingested_at", "1 day").alias("w"), "hash").agg(F.count(F.lit(1)).alias("n"))
    return _drain(g.select(F.to_date("w.start").alias("day"), "hash", "n"), "update", ["day", "hash"])


def stm09_throttle(spark, d):
    """Alerts per source, at most one in six hours."""
    events = _stream(spark, d).where("src is not null and ingested_at is not null").select(F.col("src").alias("source"), F.col("ingested_at").alias("at"))
    return _drain(announce.throttled(events, "source", "at", 6 * 3600), "append").where("kind = 'alert'").select("source", F.col("at").cast("timestamp_ntz").alias("at"))


def stm02_upsert_batches(spark, d):
    """State of the upsert over a log written by idempotent micro-batches."""
    base = scratch(spark)
    q = announce.upsert_batches(_stream(spark, d), f"{base}/log", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    log = spark.read.parquet(f"{base}/log").withColumn("country", F.nullif("country", F.lit("??")))
    return latest_view(log, ["hash", "ip"])


def stm05_rollover(spark, d):
    """Rows per event day and hour of arrival: a new day is a new window."""
    s = _stream(spark, d).withWatermark("ingested_at", "2 days")
    g = s.groupBy(F.window("ingested_at", "1 day").alias("w"), F.hour("ingested_at").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return _drain(g.select(F.to_date("w.start").alias("day"), "hour", "n"), "update", ["day", "hour"])


def stm07_tiers(spark, d):
    """Worklists by activity: active in three days, dormant, never seen."""
    o = observations(spark, d).groupBy("hash").agg(F.max("last_seen").alias("last"), F.min("first_seen").alias("first"))
    day = F.lit(AS_OF).cast("date")
    tier = F.when(F.col("last") >= F.date_sub(day, 3), "active").when(F.col("last").isNotNull(), "dormant").otherwise("new")
    b = bridge(spark, d).select("hash", "seeders").join(o, "hash", "left")
    return b.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.sum("seeders").alias("seeders"))


QUERIES = {f.__name__: f for f in (stm02_upsert_batches, stm05_rollover, stm07_tiers, stm01_stream_dedup, stm03_state_last_seen, stm04_retention, stm06_resume, stm08_hot_lane, stm09_throttle)}

_UP = "upper(trim(country, E' \\t\\n\\r'))"
_OBS = f"obs as (select lower(hash) as hash, ip, case when {_UP} in ('', 'XX', '??', 'OTHER') or country is null then '??' else {_UP} end as country, first_seen, last_seen, ingested_at from peers where not (starts_with(ip, '_queried_') or starts_with(ip, '_marker_')))"
ORACLE = {
    "stm04_retention": f"with {_OBS} select distinct hash, ip from obs",
    "stm06_resume": f"with {BRIDGE} select hash, seeders from bridge where hash not in (select lower(hash) from peers where last_seen = date '{AS_OF}' and hash is not null)",
    "stm08_hot_lane": f"with {_OBS}, {BRIDGE} select ingested_at::date as day, hash, count(*) as n from obs where hash in (select hash from bridge where seeders >= 200) group by 1, 2",
    "stm09_throttle": f"""with recursive e as (select distinct src as source, date_trunc('second', ingested_at) as t from peers where not (starts_with(ip, '_queried_') or starts_with(ip, '_marker_')) and src is not null and ingested_at is not null),
  a as (select source, min(t) as t from e group by source union all select a.source, min(e.t) from a join e on e.source = a.source and e.t >= a.t + interval 6 hours group by a.source)
  select source, t as "at" from a""",
    "stm02_upsert_batches": RELATIONAL["set08_upsert_view"],
    "stm05_rollover": f"with {_OBS} select ingested_at::date as day, hour(ingested_at)::int as hour, count(*) as n from obs group by 1, 2",
    "stm07_tiers": f"""with {OBS}, {BRIDGE}, l as (select hash, max(last_seen) as last from obs group by 1)
  select case when last >= date '{AS_OF}' - 3 then 'active' when last is not null then 'dormant' else 'new' end as tier, count(*) as n, sum(seeders)::bigint as seeders from bridge left join l using (hash) group by 1""",
    "stm01_stream_dedup": f"with {_OBS} select ingested_at::date as day, hash, country, count(distinct ip) as n_ips from obs group by 1, 2, 3",
    "stm03_state_last_seen": f"with {_OBS} select hash, ip, min(first_seen) as first_seen, max(last_seen) as last_seen from obs group by 1, 2",
}
