"""Queries p2_, p3_ and p4_: hot keys, trailing periods, implausible readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peertide.functions.ids import is_observer, norm_id
from peertide.operators.anomaly import implausible
from peertide.operators.rolling import last_loaded, trailing_totals
from peertide.operators.skew import salted_counts
from peertide.session import table

#: Share of all rows from which a key counts as huge in p2_found.
HUGE = 0.04
#: Most addresses that can be counted: for titles the number of IPv4 addresses outside any doubt, for channels the estimator's end.
TITLE_UPPER = 50_000_000.0
CHANNEL_UPPER = 50_000.0
#: Usual deviations from which a reading is a spike. The deviation is a median of residuals that still hold the rhythm of the
#: day, so for channels (four runs a day, a strong rhythm) it is larger and the number smaller.
TITLE_DEVIATIONS, CHANNEL_DEVIATIONS = 7.0, 5.0


def _per_hash(spark: SparkSession, d: str) -> DataFrame:
    ip = F.col("ip")
    return salted_counts(table(spark, d, "peers").select("hash", "ip"), F.lower("hash"), ip, is_observer(ip))


def _per_ip_id(spark: SparkSession, d: str) -> DataFrame:
    return salted_counts(table(spark, d, "hashes").select("ip_id", "hash"), norm_id("ip_id"), F.lower("hash"))


def p2_hash(spark: SparkSession, d: str) -> DataFrame:
    """Rows and distinct observers of every hash."""
    return _per_hash(spark, d).select(F.col("key").alias("hash"), "n_rows", F.col("n_members").alias("n_ips"))


def p2_ip_id(spark: SparkSession, d: str) -> DataFrame:
    """Rows and distinct hashes of every ip_id of hashes."""
    return _per_ip_id(spark, d).select(F.col("key").alias("ip_id"), "n_rows", F.col("n_members").alias("n_hashes"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The keys that hold at least 4 % of all rows, taken from the results per key."""
    huge = (F.col("n_rows") >= HUGE * F.col("n_total")) & F.col("key").isNotNull()
    hashes = _per_hash(spark, d).where(huge).select(F.lit("hash").alias("key_field"), F.col("key").alias("key_value"))
    ids = _per_ip_id(spark, d).where(huge).select(F.lit("ip_id").alias("key_field"), F.col("key").alias("key_value"))
    return hashes.unionByName(ids)


def p3_trailing(spark: SparkSession, d: str) -> DataFrame:
    """Totals and averages over the trailing 7 and 30 days of each title and day of its life."""
    t = table(spark, d, "title_demand").select("ip_id", "date", "ip_count", "loaded_at")
    out = trailing_totals(t, norm_id("ip_id"), F.col("date"), F.col("ip_count"), F.col("loaded_at"))
    return out.select(
        F.col("entity").alias("ip_id"), F.col("day").alias("obs_date"), "total_7", "avg_7", "total_30", "avg_30"
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The days on which a trailing total is 0."""
    windows = F.array(
        *[F.struct(F.lit(w).alias("window_days"), F.col(f"total_{w}").alias("total")) for w in (7, 30)]
    )
    return (
        p3_trailing(spark, d)
        .select("ip_id", F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"), F.explode(windows).alias("w"))
        .where("w.total = 0")
        .select("ip_id", "obs_date", F.col("w.window_days").alias("window_days"))
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Readings of titles and channels that cannot be true."""
    t = table(spark, d, "title_demand").select("ip_id", "date", "ip_count", "loaded_at")
    daily = last_loaded(
        t.where("ip_id is not null and date is not null"),
        {"entity": norm_id("ip_id"), "day": F.col("date")},
        F.col("ip_count"),
        F.col("loaded_at"),
    )
    titles = implausible(daily, F.col("entity"), F.col("day"), F.col("value"), upper=TITLE_UPPER, deviations=TITLE_DEVIATIONS)
    runs = (
        table(spark, d, "acestream_demand")
        .where("infohash is not null and run_ts is not null")
        .groupBy("infohash", "run_ts")
        .agg(F.max("bep33_leechers").alias("value"))
    )
    channels = implausible(runs, F.col("infohash"), F.col("run_ts"), F.col("value"), upper=CHANNEL_UPPER, deviations=CHANNEL_DEVIATIONS)
    return titles.select(
        F.lit("title_demand").alias("table_name"),
        F.col("series").alias("series_key"),
        F.date_format("at", "yyyy-MM-dd").alias("obs_at"),
    ).unionByName(
        channels.select(
            F.lit("acestream_demand").alias("table_name"),
            F.col("series").alias("series_key"),
            F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("obs_at"),
        )
    )


QUERIES = {f.__name__: f for f in (p2_hash, p2_ip_id, p2_found, p3_trailing, p3_found, p4_found)}

_NORM = "lower(trim(ip_id, E' \\t\\n\\r'))"
_LAST = f"""select {_NORM} as ip_id, date, max_by(coalesce(ip_count, 0), (loaded_at, coalesce(ip_count, -9000000000000000000))) as v,
  max_by(ip_count is null, (loaded_at, coalesce(ip_count, -9000000000000000000))) as is_null
  from title_demand where ip_id is not null and date is not null group by 1, 2"""
_TRAIL = f"""with d as ({_LAST}),
life as (select ip_id, min(date) as f, max(date) as l from d group by 1),
cal as (select ip_id, unnest(generate_series(f, l, interval 1 day))::date as obs_date from life),
full_days as (select c.ip_id, c.obs_date, coalesce(d.v, 0) as v from cal c left join d on d.ip_id = c.ip_id and d.date = c.obs_date),
tot as (select ip_id, obs_date,
  sum(v) over (partition by ip_id order by obs_date rows between 6 preceding and current row)::bigint as total_7,
  sum(v) over (partition by ip_id order by obs_date rows between 29 preceding and current row)::bigint as total_30 from full_days)
"""
_FLAGS = """{n}p as (select series, ts, value::double as v from {n}src where value is not null),
{n}v as (select series, ts, ln(v) as x from {n}p where v > 0 and v <= {upper}),
{n}m as (select *, x - median(x) over (partition by series order by ts rows between 7 preceding and 7 following) as r from {n}v),
{n}u as (select *, 1.4826 * median(abs(r)) over (partition by series) as usual from {n}m),
{n}a as (select *, case when abs(r) > ln(2) and abs(r) > {k} * usual then sign(r) else 0 end as side from {n}u),
{n}b as (select *, row_number() over (partition by series order by ts) - row_number() over (partition by series, side order by ts) as g from {n}a),
{n}c as (select *, count(*) over (partition by series, side, g) as n from {n}b),
{n}s as (select *, row_number() over (partition by series order by ts) - row_number() over (partition by series, v order by ts) as g from {n}p),
{n}t as (select *, count(*) over (partition by series, v, g) as n from {n}s),
{n}hits as (select series, ts from {n}c where side <> 0 and n <= 3
  union select series, ts from {n}t where n >= 6 and v <> 0
  union select series, ts from {n}p where v < 0 or v > {upper})"""

ORACLE = {
    "p2_hash": """select lower(hash) as hash, count(*) as n_rows,
  count(distinct case when not (starts_with(ip, '_queried_') or starts_with(ip, '_marker_')) then ip end) as n_ips
  from peers group by 1""",
    "p2_ip_id": f"select {_NORM} as ip_id, count(*) as n_rows, count(distinct lower(hash)) as n_hashes from hashes group by 1",
    "p2_found": f"""select 'hash' as key_field, lower(hash) as key_value from peers where hash is not null group by 2
  having count(*) >= 0.04 * (select count(*) from peers)
  union all select 'ip_id', {_NORM} from hashes where ip_id is not null group by 2
  having count(*) >= 0.04 * (select count(*) from hashes)""",
    "p3_trailing": _TRAIL + "select ip_id, obs_date, total_7, total_7 / 7.0::double as avg_7, total_30, total_30 / 30.0::double as avg_30 from tot",
    "p3_found": _TRAIL
    + """select ip_id, strftime(obs_date, '%Y-%m-%d') as obs_date, 7 as window_days from tot where total_7 = 0
  union all select ip_id, strftime(obs_date, '%Y-%m-%d'), 30 from tot where total_30 = 0""",
    "p4_found": "with d as (" + _LAST + "), tsrc as (select ip_id as series, date as ts, case when not is_null then v end as value from d),\n"
    + "csrc as (select infohash as series, run_ts as ts, max(bep33_leechers) as value from acestream_demand "
    + "where infohash is not null and run_ts is not null group by 1, 2),\n"
    + _FLAGS.format(n="t", upper="50000000", k=TITLE_DEVIATIONS) + ",\n" + _FLAGS.format(n="c", upper="50000", k=CHANNEL_DEVIATIONS) + """
select 'title_demand' as table_name, series as series_key, strftime(ts, '%Y-%m-%d') as obs_at from thits
union all select 'acestream_demand', series, strftime(ts, '%Y-%m-%d %H:%M:%S') from chits""",
}
