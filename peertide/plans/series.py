"""Queries win*, dq*, skt*: series, quality checks, Bloom filters."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from peertide.operators import quality, series, sketches
from peertide.plans.common import AS_OF, BRIDGE, DAILY, OBS, WEEKLY, bridge, daily, observations, weekly
from peertide.session import table


def _day() -> Column:
    return F.lit(AS_OF).cast("date")


def _axis(spark, d, n):
    """The last n days with demand, up to the day."""
    return daily(spark, d).where(F.col("date") <= _day()).select("date").distinct().orderBy(F.desc("date")).limit(n)


def win01_dod_delta(spark, d):
    """Change of each title against calendar yesterday."""
    return series.day_delta(daily(spark, d), ["ip_id"], "date", "value")


def win02_previous_total(spark, d):
    """Total per day and the total of the previous day that exists: a window over one row per day."""
    t = daily(spark, d).groupBy("date").agg(F.sum("value").alias("total"))
    return t.withColumn("previous", F.lag("total").over(Window.orderBy("date")))  # one row per calendar day


def win03_dense_series(spark, d):
    """Fourteen days per title, zeros where nothing was counted."""
    s = series.dense(daily(spark, d).where(F.col("date") <= _day()), "ip_id", "date", "value", 14)
    return s.select("ip_id", F.array_join(F.transform("series", lambda x: x.cast("string")), ",").alias("series"))


def win04_avg7(spark, d):
    """Mean of the days before the newest one among the last eight with demand, missing titles 0, beside the newest day: the divisor is
    the number of those days, seven or fewer."""
    axis = _axis(spark, d, 8)
    today, n = axis.agg(F.max("date"), F.count(F.lit(1))).first()  # one row
    x = daily(spark, d).join(axis, "date")
    now = F.coalesce(F.sum(F.when(F.col("date") == F.lit(today), F.col("value"))), F.lit(0))
    prior = F.coalesce(F.sum(F.when(F.col("date") < F.lit(today), F.col("value"))), F.lit(0))
    return x.groupBy("ip_id").agg(now.alias("today"), (prior / F.lit(float(max(1, (n or 1) - 1)))).alias("avg7"))


def win06_surge(spark, d, minutes: int = 1080):
    """Three lists of at most 40 titles, for a day of which `minutes` are gone: the largest ratio and the largest rise of the
    projected day over the mean (from a mean of 1000), and breakouts (mean under 150, 1500 today)."""
    part = max(0.10, minutes / 1440)
    x = win04_avg7(spark, d).withColumn("projected", F.col("today") / F.lit(part))
    lists = {
        "ratio": (F.col("avg7") >= 1000, F.bround(F.col("projected") / F.col("avg7"), 1)),
        "absolute": (F.col("avg7") >= 1000, F.bround(F.col("projected") - F.col("avg7"), 0)),
        "breakout": ((F.col("avg7") < 150) & (F.col("today") >= 1500), F.col("today").cast("double")),
    }
    out = None
    for name, (where, measure) in lists.items():
        top = x.where(where).select(F.lit(name).alias("list"), "ip_id", "today", measure.alias("measure")).orderBy(F.desc("measure"), "ip_id").limit(40)
        out = top if out is None else out.unionByName(top)
    return out


def win07_wow(spark, d):
    """Change of the last seven days against the seven before, in percent."""
    s = series.dense(daily(spark, d).where(F.col("date") <= _day()), "ip_id", "date", "value", 14)
    return s.select("ip_id", series.half_change(F.col("series"), 14).alias("change"))


def win09_topn(spark, d):
    """The ten largest titles of each category on each date."""
    w = weekly(spark, d).groupBy("date", "category", "ip_id").agg(F.sum("ip_count").alias("total"))
    rank = F.row_number().over(Window.partitionBy("date", "category").orderBy(F.desc("total"), "ip_id"))
    return w.withColumn("rank", rank).where("rank <= 10")


def win14_last_positive(spark, d):
    """The last run with demand of each channel."""
    a = table(spark, d, "acestream_demand")
    return a.groupBy("infohash").agg(F.max(F.when(F.col("bep33_leechers") > 0, F.col("run_ts"))).alias("last_run"), F.count_distinct("run_ts").alias("n_runs"))


def win18_best_sighting(spark, d):
    """The sighting of best availability per channel, the earliest of equals."""
    a = table(spark, d, "acestream_demand").where("availability is not null")
    m = F.min(F.struct((-F.col("availability")).alias("a"), "run_ts", "peer_country")).alias("m")
    return a.groupBy("infohash").agg(m).select("infohash", (-F.col("m.a")).alias("availability"), F.col("m.run_ts").alias("run_ts"), F.col("m.peer_country").alias("peer_country"))


def dq01_decoy(spark, d):
    """Titles whose hashes repeat few release names."""
    return quality.decoys(bridge(spark, d), "ip_id", "raw_name")


def dq02_share(spark, d):
    """Titles with much demand from data centres."""
    t = table(spark, d, "title_demand").where("ip_count >= 500 and ip_count <= 50000000 and ip_id is not null").select("date", F.lower(F.btrim("ip_id")).alias("ip_id"), "ip_count", "dc_ip_count").distinct()
    return t.where(F.col("dc_ip_count") / F.col("ip_count") >= 0.25).select("date", "ip_id", "ip_count", "dc_ip_count").distinct()


def dq06_spikes(spark, d):
    """Titles that rose by half on the day."""
    x = win01_dod_delta(spark, d).where(F.col("date") == _day())
    return quality.spikes(x, "ip_id")


def dq07_dead(spark, d):
    """Hashes by life sign: alive in the week, dead, never seen."""
    o = observations(spark, d).groupBy("hash").agg(F.max("last_seen").alias("last"))
    b = bridge(spark, d).select("hash").join(o, "hash", "left")
    sign = F.when(F.col("last") >= F.date_sub(_day(), 7), "alive").when(F.col("last").isNotNull(), "dead").otherwise("never")
    return b.groupBy(sign.alias("sign")).agg(F.count(F.lit(1)).alias("n"))


def dq09_health(spark, d):
    """Freshness checks of peers as rows."""
    return quality.health(observations(spark, d), "last_seen", _day(), least=100)


def skt01_or_merge(spark, d):
    """Bloom filters of each title's hashes, united (filters made of MD5 digests stand in for measured ones)."""
    f = F.unhex(F.repeat(F.concat(F.md5("hash"), F.md5(F.concat("hash", F.lit("x")))), 8))
    h = bridge(spark, d).where("ip_id is not null").select("ip_id", f.alias("f"))
    return h.groupBy("ip_id").agg(F.call_function("bitmap_count", sketches.merged(F.col("f"))).alias("bits_set"))


def _filled(n):
    """A filter with as many leading bytes set as n asks for (stands in for a measured one); null for null, which least() would skip."""
    n = F.when(n.isNotNull(), F.greatest(F.least(n, F.lit(256)), F.lit(0)).cast("int"))
    return F.unhex(F.concat(F.repeat(F.lit("ff"), n), F.repeat(F.lit("00"), F.lit(256) - n)))


def skt02_estimate(spark, d):
    """Cardinality of one sparse filter per hash: as many leading bytes set as its seeders ask for."""
    h = bridge(spark, d).where("seeders is not null")
    return h.select("hash", sketches.estimate(_filled(F.col("seeders"))).alias("members"))


def skt03_pass_totals(spark, d):
    """Per pass over the channels: how many had filter data, and the sums of the estimates of their seeders and leechers (a channel's
    values stand in every row of it and count once)."""
    a = table(spark, d, "acestream_demand").groupBy("run_ts", "infohash").agg(F.max("bep33_seeders").alias("s"), F.max("bep33_leechers").alias("l"))
    e = a.select("run_ts", *[F.coalesce(sketches.estimate(_filled(F.col(c))), F.lit(0)).alias(c) for c in ("s", "l")])
    return e.groupBy("run_ts").agg(F.count_if((F.col("s") > 0) | (F.col("l") > 0)).alias("n_with_data"), F.sum("s").alias("seeders"), F.sum("l").alias("leechers"))


QUERIES = {k: f for k, f in globals().items() if k[:3] in ("win", "dq0", "skt") and callable(f)}

_D = f"date '{AS_OF}'"
_AXIS = f"axis as (select date from (select distinct date from daily where date <= {_D}) order by date desc limit 14)"
_DENSE = f"""dense as (select k.ip_id, axis.date, coalesce(daily.value, 0) as v, row_number() over (partition by k.ip_id order by axis.date) as i
  from (select distinct ip_id from daily where date <= {_D}) k cross join axis left join daily on daily.ip_id = k.ip_id and daily.date = axis.date)"""
_AVG = f"""x as (select ip_id, coalesce(max(case when date = {_D} then value end), 0) as today, coalesce(sum(case when date < {_D} then value end), 0) / 7.0::double as avg7
  from daily where date between {_D} - 7 and {_D} group by 1)"""
_DELTA = "del as (select a.ip_id, a.date, a.value, coalesce(b.value, 0) as previous, a.value - coalesce(b.value, 0) as delta from daily a left join daily b on a.ip_id = b.ip_id and b.date = a.date - 1)"
_EST = "case when {b} >= 2048 then 50000 when {b} <= 0 then 0 else floor(ln((2048 - {b}) / 2048.0::double) / (2 * ln(1 - 1 / 2048.0::double)))::int end"
_EIGHT = f"""a as (select distinct date from daily where date <= date '{AS_OF}' order by date desc limit 8), m as (select max(date) as t, greatest(count(*) - 1, 1) as n from a),
  e as (select ip_id, coalesce(sum(value) filter (date = t), 0)::bigint as today, coalesce(sum(value) filter (date < t), 0)::double / any_value(n) as avg7 from daily join a using (date), m group by 1)"""
ORACLE = {
    "win01_dod_delta": f"with {DAILY}, {_DELTA} select * from del",
    "win02_previous_total": f"with {DAILY}, t as (select date, sum(value)::bigint as total from daily group by 1) select date, total, lag(total) over (order by date) as previous from t",
    "win03_dense_series": f"with {DAILY}, {_AXIS}, {_DENSE} select ip_id, string_agg(v::varchar, ',' order by date) as series from dense group by 1",
    "win04_avg7": f"""with {DAILY}, {_EIGHT} select ip_id, today, avg7 from e""",
    "win06_surge": f"""with {DAILY}, {_EIGHT}, l as (select 'ratio' as list, ip_id, today, round_even(today / 0.75::double / avg7, 1) as measure from e where avg7 >= 1000
  union all select 'absolute', ip_id, today, round_even(today / 0.75::double - avg7, 0) from e where avg7 >= 1000
  union all select 'breakout', ip_id, today, today::double from e where avg7 < 150 and today >= 1500),
  r as (select *, row_number() over (partition by list order by measure desc, ip_id) as rn from l) select list, ip_id, today, measure from r where rn <= 40""",
    "win07_wow": f"""with {DAILY}, {_AXIS}, {_DENSE}, h as (select ip_id, sum(case when i > 7 then v end) / 7.0::double as now, sum(case when i <= 7 then v end) / 7.0::double as prior from dense group by 1)
  select ip_id, case when prior > 0 then (now - prior) / prior * 100 when now > 0 then 100.0::double end as change from h""",
    "win09_topn": f"""with {WEEKLY}, w as (select date, category, ip_id, sum(ip_count)::bigint as total from weekly group by 1, 2, 3)
  select * from (select *, row_number() over (partition by date, category order by total desc, ip_id) as rank from w) where rank <= 10""",
    "win14_last_positive": "select infohash, max(case when bep33_leechers > 0 then run_ts end) as last_run, count(distinct run_ts) as n_runs from acestream_demand group by 1",
    "win18_best_sighting": """select infohash, availability, run_ts, peer_country from (select *, row_number() over (partition by infohash order by availability desc, run_ts, peer_country) as rn
  from acestream_demand where availability is not null) where rn = 1""",
    "dq01_decoy": f"""with {BRIDGE}, n as (select ip_id, raw_name, count(*) as n from bridge where ip_id is not null and raw_name is not null group by 1, 2)
  select ip_id, sum(n)::bigint as n_rows, count(*) as n_names, max(n) as n_top from n group by 1 having sum(n) >= 5 and max(n) >= 4 and count(*) / sum(n) < 0.5""",
    "dq02_share": """select distinct date, lower(trim(ip_id)) as ip_id, ip_count, dc_ip_count from title_demand
  where ip_count >= 500 and ip_count <= 50000000 and ip_id is not null and dc_ip_count::double / ip_count >= 0.25""",
    "dq06_spikes": f"""with {DAILY}, {_DELTA}, g as (select ip_id, sum(value)::bigint as value, sum(delta)::bigint as delta, sum(previous)::bigint as previous from del
  where date = {_D} and value >= 100 and delta > 0 group by 1) select *, delta::double / previous as pct from g where previous > 0 and delta::double / previous >= 0.5 order by delta desc, ip_id limit 20""",
    "dq07_dead": f"""with {OBS}, {BRIDGE}, l as (select hash, max(last_seen) as last from obs group by 1)
  select case when last >= {_D} - 7 then 'alive' when last is not null then 'dead' else 'never' end as sign, count(*) as n from bridge left join l using (hash) group by 1""",
    "dq09_health": f"""with {OBS} select 'rows_today' as name, count(*)::varchar as value, count(*) >= 100 as ok from obs where last_seen = {_D}
  union all select 'newest', max(last_seen)::varchar, max(last_seen) >= {_D} from obs union all select 'undated', count(*)::varchar, count(*) = 0 from obs where last_seen is null""",
    "skt01_or_merge": f"""with {BRIDGE} select ip_id, bit_count(bit_or(from_hex(repeat(md5(hash) || md5(hash || 'x'), 8))::bit)) as bits_set from bridge where ip_id is not null group by 1""",
    "skt02_estimate": f"""with {BRIDGE}, s as (select hash, least(seeders, 256) * 8 as b from bridge where seeders is not null)
  select hash, case when b >= 2048 then 50000 when b <= 0 then 0 else floor(ln((2048 - b) / 2048.0::double) / (2 * ln(1 - 1 / 2048.0::double)))::int end as members from s""",
    "skt03_pass_totals": f"""with a as (select run_ts, infohash, greatest(least(coalesce(max(bep33_seeders), 0), 256), 0) * 8 as s, greatest(least(coalesce(max(bep33_leechers), 0), 256), 0) * 8 as l from acestream_demand group by 1, 2),
  e as (select run_ts, coalesce({_EST.format(b="s")}, 0) as s, coalesce({_EST.format(b="l")}, 0) as l from a)
  select run_ts, count(*) filter (s > 0 or l > 0) as n_with_data, sum(s)::bigint as seeders, sum(l)::bigint as leechers from e group by 1""",
}
