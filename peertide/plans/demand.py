"""Queries agg*: distinct-observer demand and the other aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peertide.operators.demand import floor_other, per_observer, tagged_union, union_demand
from peertide.plans.common import BRIDGE, OBS, WEEKLY, bridge, observations, weekly
from peertide.session import table

FLOOR = 10


def title_observations(spark: SparkSession, d: str) -> DataFrame:
    obs = observations(spark, d).where("last_seen is not null").select("hash", "ip", "country", "src", F.col("last_seen").alias("obs_date"))
    return obs.join(bridge(spark, d).select("hash", "ip_id"), "hash").where("ip_id is not null")


def agg01_union_demand(spark, d):
    """Distinct observers per day, title and country, with the part each source saw."""
    return union_demand(title_observations(spark, d), ["obs_date", "ip_id"])


def agg01_union_by_source(spark, d):
    """The same per title over all days, without countries."""
    one = per_observer(title_observations(spark, d), ["ip_id"])
    return one.groupBy("ip_id").agg(
        F.count(F.lit(1)).alias("ip_count"), F.sum("in_dht").alias("ip_count_dht"), F.sum("in_harv").alias("ip_count_harv"), F.sum("in_pex").alias("ip_count_pex")
    )


def agg02_single_country(spark, d):
    """The one country of each observer of a title."""
    return per_observer(title_observations(spark, d), ["ip_id"]).select("ip_id", "ip", "country")


def agg03_count_distinct(spark, d):
    """Distinct observers per hash and country: distinct rows first, so that one hot hash spreads over its observers."""
    return observations(spark, d).select("hash", "country", "ip").distinct().groupBy("hash", "country").agg(F.count(F.lit(1)).alias("n_ips"))


def agg04_max_passes(spark, d):
    """Repeated passes of a channel's run collapse to their maxima."""
    a = table(spark, d, "acestream_demand")
    return a.groupBy("run_ts", "infohash", "peer_country").agg(F.max("peer_count").alias("peer_count"), F.max("bep33_leechers").alias("bep33_leechers"), F.max("availability").alias("availability"))


def agg05_mixed(spark, d):
    """Sum, distinct, max, min and first non-null per title."""
    b = bridge(spark, d).where("ip_id is not null")
    return b.groupBy("ip_id").agg(F.count_distinct("hash").alias("hash_count"), F.sum("seeders").alias("seeders"), F.max("seeders").alias("max_seeders"), F.min("title").alias("title"), F.max("category").alias("category"))


def agg06_collapse_first_nonblank(spark, d):
    """One row per day and title: the first non-blank title by load time, the largest count."""
    t = table(spark, d, "title_demand").where("ip_id is not null")
    named = F.when(F.trim("title") != "", F.struct("loaded_at", "title"))
    return t.groupBy("date", F.lower(F.btrim("ip_id")).alias("ip_id")).agg(F.min(named).alias("w"), F.max("ip_count").alias("ip_count")).select("date", "ip_id", F.col("w.title").alias("title"), "ip_count")


def agg07_floor_other(spark, d):
    """The daily feed: countries under the floor pool into Other, pools under it go."""
    return floor_other(agg01_union_demand(spark, d), ["obs_date", "ip_id"], FLOOR)


def agg09_baseline_dedup_sum(spark, d):
    """Exact repeats go before the sum."""
    t = table(spark, d, "title_country").select("date", "country", "ip_id", "ip_count").distinct()
    return t.groupBy("date", "ip_id").agg(F.sum("ip_count").alias("ip_count"))


def agg11_grouping_sets(spark, d):
    """Totals per title, per country, per both and overall in one pass."""
    w = weekly(spark, d)
    w.createOrReplaceTempView("peertide_weekly")
    return spark.sql(
        "select date, country, ip_id, sum(ip_count) as total_ip, count(1) as n_rows from peertide_weekly "
        "group by grouping sets ((date, ip_id), (date, country), (date, country, ip_id), (date))"
    )


def agg12_mode(spark, d):
    """Most frequent release name per title, with its count, distinct names and all names; ties by name."""
    n = bridge(spark, d).where("ip_id is not null and raw_name is not null").groupBy("ip_id", "raw_name").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("ip_id").agg(F.min(F.struct((-F.col("n")).alias("m"), "raw_name")).alias("w"), F.count(F.lit(1)).alias("n_names"), F.sum("n").alias("n_hashes")).select(
        "ip_id", F.col("w.raw_name").alias("top_name"), (-F.col("w.m")).alias("top_count"), "n_names", "n_hashes"
    )


def agg14_having(spark, d):
    """Hashes seen in at least five known countries."""
    c = observations(spark, d).where("country is not null").select("hash", "country").distinct()
    return c.groupBy("hash").agg(F.count(F.lit(1)).alias("n_countries")).where("n_countries >= 5")


def agg17_ratio(spark, d):
    """Share of a title's hashes whose release name shares a word with the title."""
    b = bridge(spark, d).where("ip_id is not null and raw_name is not null and title is not null")
    w = lambda c: F.split(F.lower(F.col(c)), "[^a-z0-9]+")
    hit = F.arrays_overlap(F.filter(w("raw_name"), lambda x: F.length(x) > 3), F.filter(w("title"), lambda x: F.length(x) > 3))
    return b.groupBy("ip_id").agg(F.avg(F.coalesce(hit, F.lit(False)).cast("double")).alias("share"), F.count(F.lit(1)).alias("n"))


def agg19_sorted_listagg(spark, d):
    """Sources of each title as one sorted string."""
    s = table(spark, d, "hashes").where("ip_id is not null").select(F.lower(F.btrim("ip_id")).alias("ip_id"), "source").distinct()
    return s.groupBy("ip_id").agg(F.count(F.lit(1)).alias("n_sources"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


def agg21_category_trend(spark, d):
    """Demand per day with a column per category."""
    t = table(spark, d, "title_demand").where("ip_count >= 0 and ip_count <= 50000000")
    return t.groupBy("date").pivot("category", ["Anime", "Movies", "Series"]).agg(F.sum("ip_count"))


def agg24_flag_counts(spark, d):
    """Counts of markers, unknown countries, late rows and all rows of peers in one pass."""
    p = table(spark, d, "peers")
    return p.agg(
        F.count_if(F.col("ip").startswith("_")).alias("n_markers"),
        F.count_if(F.upper(F.btrim(F.coalesce("country", F.lit("")))).isin("", "XX", "??")).alias("n_unknown"),
        F.count_if(F.to_date("ingested_at") > F.col("last_seen")).alias("n_late"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def agg26_first_row_measure(spark, d):
    """A measure of the run goes to its first country only, so that sums over countries count it once."""
    a = agg04_max_passes(spark, d)
    first = a.groupBy("run_ts", "infohash").agg(F.min("peer_country").alias("first_country"), F.max("bep33_leechers").alias("run_leechers"))
    own = F.when(F.col("peer_country") == F.col("first_country"), F.col("run_leechers")).otherwise(0)
    return a.join(first, ["run_ts", "infohash"]).select("run_ts", "infohash", "peer_country", "peer_count", own.alias("leechers"))


def src09_federated(spark, d):
    """Sources that exist, tagged and united; one that is missing is skipped."""
    parts = {s: table(spark, d, "peers").where(F.col("src") == s).drop("src") for s in ("dht", "harv")}
    return tagged_union({**parts, "velocity": None}).groupBy("src").agg(F.count(F.lit(1)).alias("n_rows"), F.max("last_seen").alias("last_seen"))


QUERIES = {k: f for k, f in globals().items() if k.startswith(("agg", "src")) and callable(f)}

_TITLE_OBS = f"""{OBS}, {BRIDGE}, tobs as (select o.hash, o.ip, o.country, o.src, o.last_seen as obs_date, b.ip_id from obs o join bridge b on b.hash = o.hash
  where o.last_seen is not null and b.ip_id is not null)"""
_RANK = "case src when 'dht' then 0 when 'harv' then 1 when 'pex' then 2 else 3 end"


def _one(keys: str) -> str:
    return f"""one as (select {keys}, ip, country, d, h, x from (select {keys}, ip, country,
  row_number() over (partition by {keys}, ip order by country is null, {_RANK}, hash, country) as rn,
  max((src = 'dht')::int) over (partition by {keys}, ip) as d, max((src = 'harv')::int) over (partition by {keys}, ip) as h,
  max((src = 'pex')::int) over (partition by {keys}, ip) as x from tobs) where rn = 1)"""


_SUMS = "count(*) as ip_count, sum(d)::bigint as ip_count_dht, sum(h)::bigint as ip_count_harv, sum(x)::bigint as ip_count_pex"
_DEMAND = f"with {_TITLE_OBS}, {_one('obs_date, ip_id')}, dem as (select obs_date, ip_id, coalesce(country, '??') as country, {_SUMS} from one group by 1, 2, 3)"
_PASSES = "passes as (select run_ts, infohash, peer_country, max(peer_count) as peer_count, max(bep33_leechers) as bep33_leechers, max(availability) as availability from acestream_demand group by 1, 2, 3)"
ORACLE = {
    "agg01_union_demand": f"{_DEMAND} select * from dem",
    "agg01_union_by_source": f"with {_TITLE_OBS}, {_one('ip_id')} select ip_id, {_SUMS} from one group by 1",
    "agg02_single_country": f"with {_TITLE_OBS}, {_one('ip_id')} select ip_id, ip, country from one",
    "agg03_count_distinct": f"with {OBS} select hash, country, count(distinct ip) as n_ips from obs group by 1, 2",
    "agg04_max_passes": f"with {_PASSES} select * from passes",
    "agg05_mixed": f"with {BRIDGE} select ip_id, count(distinct hash) as hash_count, sum(seeders)::bigint as seeders, max(seeders) as max_seeders, min(title) as title, max(category) as category from bridge where ip_id is not null group by 1",
    "agg06_collapse_first_nonblank": "select date, lower(trim(ip_id)) as ip_id, min(case when trim(title) <> '' then (loaded_at, title) end)[2] as title, max(ip_count) as ip_count from title_demand where ip_id is not null group by 1, 2",
    "agg07_floor_other": f"""{_DEMAND} select obs_date, ip_id, case when ip_count >= {FLOOR} then country else 'Other' end as country, sum(ip_count)::bigint as ip_count,
  sum(ip_count_dht)::bigint as ip_count_dht, sum(ip_count_harv)::bigint as ip_count_harv, sum(ip_count_pex)::bigint as ip_count_pex from dem group by 1, 2, 3 having sum(ip_count) >= {FLOOR}""",
    "agg09_baseline_dedup_sum": "select date, ip_id, sum(ip_count)::bigint as ip_count from (select distinct date, country, ip_id, ip_count from title_country) group by 1, 2",
    "agg11_grouping_sets": f"with {WEEKLY} select date, country, ip_id, sum(ip_count)::bigint as total_ip, count(*) as n_rows from weekly group by grouping sets ((date, ip_id), (date, country), (date, country, ip_id), (date))",
    "agg12_mode": f"""with {BRIDGE}, n as (select ip_id, raw_name, count(*) as n from bridge where ip_id is not null and raw_name is not null group by 1, 2),
  r as (select *, row_number() over (partition by ip_id order by n desc, raw_name) as rn, count(*) over (partition by ip_id) as n_names, sum(n) over (partition by ip_id) as n_hashes from n)
  select ip_id, raw_name as top_name, n as top_count, n_names, n_hashes::bigint as n_hashes from r where rn = 1""",
    "agg14_having": f"with {OBS} select hash, count(distinct country) as n_countries from obs group by 1 having count(distinct country) >= 5",
    "agg17_ratio": f"""with {BRIDGE} select ip_id, avg(case when list_has_any(list_filter(regexp_split_to_array(lower(raw_name), '[^a-z0-9]+'), lambda x: length(x) > 3),
  list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'), lambda x: length(x) > 3)) then 1.0::double else 0.0::double end) as share, count(*) as n from bridge
  where ip_id is not null and raw_name is not null and title is not null group by 1""",
    "agg19_sorted_listagg": "select lower(trim(ip_id)) as ip_id, count(distinct source) as n_sources, string_agg(distinct source, ',' order by source) as sources from hashes where ip_id is not null group by 1",
    "agg21_category_trend": """select date, sum(ip_count) filter (category = 'Anime')::bigint as "Anime", sum(ip_count) filter (category = 'Movies')::bigint as "Movies",
  sum(ip_count) filter (category = 'Series')::bigint as "Series" from title_demand where ip_count >= 0 and ip_count <= 50000000 group by 1""",
    "agg24_flag_counts": """select count(*) filter (starts_with(ip, '_')) as n_markers, count(*) filter (upper(trim(coalesce(country, ''))) in ('', 'XX', '??')) as n_unknown,
  count(*) filter (ingested_at::date > last_seen) as n_late, count(*) as n_rows from peers""",
    "agg26_first_row_measure": f"""with {_PASSES} select run_ts, infohash, peer_country, peer_count, case when peer_country = min(peer_country) over w
  then max(bep33_leechers) over w else 0 end as leechers from passes window w as (partition by run_ts, infohash)""",
    "src09_federated": "select src, count(*) as n_rows, max(last_seen) as last_seen from peers where src in ('dht', 'harv') group by 1",
}
