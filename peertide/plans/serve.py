"""Queries api_*: what a dashboard asks, one DataFrame each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peertide.plans.common import AS_OF, BRIDGE, DAILY, WEEKLY, bridge, daily, weekly
from peertide.session import table

#: Sort orders a caller may ask for.
SORTS = {"ip": lambda: [F.desc("ip_count"), "ip_id"], "ip_asc": lambda: [F.asc("ip_count"), "ip_id"], "title": lambda: [F.asc_nulls_last("title"), "ip_id"], "title_desc": lambda: [F.desc_nulls_last("title"), "ip_id"]}


def _day() -> Column:
    return F.lit(AS_OF).cast("date")


def titles(spark, d, *, category: str | None = None, country: str | None = None, q: str | None = None, sort: str = "ip", limit: int = 200) -> DataFrame:
    """Titles of the day by optional filters; the limit is at most 1000."""
    w = weekly(spark, d).where(F.col("date") == _day())
    if country:
        w = w.where(F.col("country") == country)
    t = w.groupBy("ip_id").agg(F.max("category").alias("category"), F.min("title").alias("title"), F.sum("ip_count").alias("ip_count"))
    if category:
        t = t.where(F.col("category") == category)
    if q:
        t = t.where(F.col("title").ilike(f"%{q}%"))
    return t.orderBy(*SORTS[sort]()).limit(min(limit, 1000))


def api_meta(spark, d):
    """Countries by demand over the week."""
    return weekly(spark, d).groupBy("country").agg(F.sum("ip_count").alias("total"), F.max("date").alias("latest"))


def api_overview(spark, d):
    """Totals per category of the day and of the day before."""
    t = table(spark, d, "title_demand").where("ip_id is not null").groupBy(F.lower(F.btrim("ip_id")).alias("ip_id")).agg(F.min("category").alias("category"))
    x = daily(spark, d).where(F.col("date").isin(_day(), F.date_sub(_day(), 1))).join(t, "ip_id")
    return x.groupBy("category").agg(F.sum(F.when(F.col("date") == _day(), F.col("value"))).alias("today"), F.sum(F.when(F.col("date") < _day(), F.col("value"))).alias("before"), F.count_distinct("ip_id").alias("n_titles"))


def api_overview_lists(spark, d):
    """Beside the totals: the twelve titles that rose most against the previous day with data, and the ten largest of each category."""
    x = daily(spark, d)
    days = [r.date for r in x.where(F.col("date") <= _day()).select("date").distinct().orderBy(F.desc("date")).limit(2).collect()]  # two rows
    now, before = x.where(F.col("date") == F.lit(days[0] if days else None)), x.where(F.col("date") == F.lit(days[1] if len(days) > 1 else None))
    now = now.select("ip_id", "value").join(before.select("ip_id", F.col("value").alias("p")), "ip_id", "left").withColumn("delta", F.col("value") - F.coalesce("p", F.lit(0)))
    movers = now.orderBy(F.desc("delta"), "ip_id").limit(12).select(F.lit("movers").alias("list"), "ip_id", "value", "delta")
    t = table(spark, d, "title_demand").where("ip_id is not null").groupBy(F.lower(F.btrim("ip_id")).alias("ip_id")).agg(F.min("category").alias("category"))
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("value"), "ip_id"))
    top = now.join(t.where("category is not null"), "ip_id").withColumn("rank", rank).where("rank <= 10").select(F.col("category").alias("list"), "ip_id", "value", "delta")
    return movers.unionByName(top)


def _sites(spark, d):
    """Sources of documents stand in for streaming sites: what they name on a day is what they carry."""
    return table(spark, d, "documents").where("source is not null")


def api_streams(spark, d):
    """The 300 sites of highest rank, with their kind and whether they were seen in the last thirty days of the table."""
    s = _sites(spark, d)
    last = s.agg(F.max("created_at").alias("newest"))
    g = s.groupBy("source").agg(F.count(F.lit(1)).alias("rank_signal"), F.max("created_at").alias("seen")).join(F.broadcast(last))  # one row
    status = F.when(F.col("seen") >= F.col("newest") - F.expr("interval 30 days"), "up").otherwise("down")
    return g.select(F.col("source").alias("domain"), F.split_part("source", F.lit("_"), F.lit(1)).alias("kind"), "rank_signal", status.alias("status")).orderBy(F.desc("rank_signal"), "domain").limit(300)


def api_stream_titles(spark, d):
    """Titles on the newest day on which sites name them, with the number and list of sites, beside their newest demand, 0 where
    there is none."""
    s = _sites(spark, d).where("ip_id is not null and created_at is not null").select(F.lower(F.btrim("ip_id")).alias("ip_id"), F.to_date("created_at").alias("date"), "source").distinct()
    day = F.broadcast(s.groupBy("ip_id").agg(F.max("date").alias("date")))
    n = s.join(day, ["ip_id", "date"]).groupBy("ip_id", "date").agg(F.count(F.lit(1)).alias("n_sites"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sites"))
    demand = daily(spark, d).groupBy("ip_id").agg(F.max(F.struct("date", "value")).alias("m")).select("ip_id", F.col("m.value").alias("ip_count"))
    return n.join(demand, "ip_id", "left").select("ip_id", "date", "n_sites", "sites", F.coalesce("ip_count", F.lit(0)).alias("ip_count"))


def api_report(spark, d):
    """Rows of the daily report: cards, thirty days of totals, the twelve largest titles of each category, the twelve largest countries.
    `report_html` makes a page of them."""
    x = daily(spark, d).where(F.col("date") <= _day())
    totals = x.groupBy("date").agg(F.sum("value").alias("value"))
    trend = totals.orderBy(F.desc("date")).limit(30).select(F.lit("trend").alias("section"), F.date_format("date", "yyyy-MM-dd").alias("label"), "value")
    on = x.where(F.col("date") == _day())
    cards = on.agg(F.count_distinct("ip_id").alias("titles"), F.sum("value").alias("observers")).select(F.explode(F.map_from_arrays(F.array(F.lit("titles"), F.lit("observers")), F.array("titles", "observers"))).alias("label", "value"))
    t = weekly(spark, d).where(F.col("date") == _day())
    by_title = t.groupBy("category", "ip_id").agg(F.sum("ip_count").alias("value"))
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("value"), "ip_id"))
    top = by_title.where("category is not null").withColumn("rank", rank).where("rank <= 12").select(F.concat(F.lit("top "), "category").alias("section"), F.col("ip_id").alias("label"), "value")
    country = t.groupBy("country").agg(F.sum("ip_count").alias("value")).orderBy(F.desc("value"), "country").limit(12).select(F.lit("countries").alias("section"), F.col("country").alias("label"), "value")
    return cards.select(F.lit("cards").alias("section"), "label", "value").unionByName(trend).unionByName(top).unionByName(country)


def report_html(rows: DataFrame) -> DataFrame:
    """One row with a page of tables, one per section; labels are escaped, numbers have thousands marked."""
    safe = F.replace(F.replace(F.replace(F.col("label"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    line = F.concat(F.lit("<tr><td>"), safe, F.lit("</td><td>"), F.coalesce(F.format_number("value", 0), F.lit("")), F.lit("</td></tr>"))
    lines = rows.groupBy("section").agg(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "label", line.alias("line")))).alias("l"))
    part = F.concat(F.lit("<h2>"), "section", F.lit("</h2><table>"), F.array_join(F.transform("l", lambda x: x["line"]), ""), F.lit("</table>"))
    return lines.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", part.alias("part")))), lambda x: x["part"]), "").alias("html"))


def api_titles_filters(spark, d):
    """Every single filter and their combinations on one day, by label."""
    asked = {"none": {}, "category": {"category": "Series"}, "country": {"country": "US"}, "q": {"q": "of"}, "all": {"category": "Movies", "country": "US", "q": "a"}, "limit": {"limit": 5000}}
    out = None
    for k, kw in asked.items():
        t = titles(spark, d, **kw).select(F.lit(k).alias("asked"), "ip_id", "ip_count")
        out = t if out is None else out.unionByName(t)
    return out


def api_title_info(spark, d):
    """Each title's row of the day, else its newest one, with title and category."""
    x = daily(spark, d).groupBy("ip_id").agg(F.max(F.struct((F.col("date") == _day()).alias("hit"), "date", "value")).alias("m"))
    t = table(spark, d, "title_demand").where("ip_id is not null").groupBy(F.lower(F.btrim("ip_id")).alias("ip_id")).agg(F.min("title").alias("title"), F.min("category").alias("category"))
    return x.join(t, "ip_id").select("ip_id", "title", "category", F.col("m.date").alias("date"), F.col("m.value").alias("value"), (~F.col("m.hit")).alias("fallback"))


def api_titles(spark, d):
    return titles(spark, d, category="Movies", q="the")


def api_title(spark, d):
    """The 25 best countries of the largest title of the day."""
    top = titles(spark, d, limit=1).select("ip_id")
    w = weekly(spark, d).where(F.col("date") == _day()).join(F.broadcast(top), "ip_id")  # one row
    return w.select("ip_id", "country", "ip_count").orderBy(F.desc("ip_count"), "country").limit(25)


def api_title_hashes(spark, d):
    """The twelve best-seeded hashes of each title, release name or else title."""
    b = bridge(spark, d).where("ip_id is not null")
    rank = F.row_number().over(Window.partitionBy("ip_id").orderBy(F.desc_nulls_last("seeders"), "hash"))
    return b.withColumn("rank", rank).where("rank <= 12").select("ip_id", "hash", "seeders", F.coalesce(F.nullif("raw_name", F.lit("")), "title").alias("name"))


def api_countries(spark, d):
    return weekly(spark, d).where(F.col("date") == _day()).groupBy("country").agg(F.sum("ip_count").alias("total"), F.count(F.lit(1)).alias("n_titles")).orderBy(F.desc("total"), "country").limit(80)


def api_trends(spark, d):
    """Demand per day and category of the last thirty days, zeros where a category has none."""
    cat = table(spark, d, "title_demand").where("ip_id is not null").groupBy(F.lower(F.btrim("ip_id")).alias("ip_id")).agg(F.min("category").alias("category"))
    x = daily(spark, d).where((F.col("date") <= _day()) & (F.col("date") > F.date_sub(_day(), 30))).join(cat, "ip_id")
    axis = x.select("date").distinct().select("date", F.explode(F.array(*[F.lit(c) for c in ("Anime", "Movies", "Series")])).alias("category"))
    return axis.join(x.groupBy("date", "category").agg(F.sum("value").alias("total")), ["date", "category"], "left").select("date", "category", F.coalesce("total", F.lit(0)).alias("total"))


def api_acestream(spark, d):
    """Channels of the latest run: seeders and leechers of the run, peers and countries of the sample."""
    a = table(spark, d, "acestream_demand")
    last = a.agg(F.max("run_ts").alias("run_ts"))
    now = a.join(F.broadcast(last), "run_ts")  # one row
    once = now.groupBy("infohash", "peer_country").agg(F.max("peer_count").alias("peer_count"), F.max("bep33_seeders").alias("s"), F.max("bep33_leechers").alias("l"), F.min("name").alias("name"))
    return once.groupBy("infohash").agg(F.min("name").alias("name"), F.max("s").alias("seeders"), F.max("l").alias("leechers"), F.sum("peer_count").alias("sample"), F.count(F.lit(1)).alias("n_countries"))


def api_export(spark, d):
    """Rows of the export endpoint, five columns, at most a thousand."""
    return titles(spark, d, limit=5000).select("title", "ip_id", "category", "ip_count").withColumn("date", F.lit(AS_OF))


QUERIES = {k: f for k, f in globals().items() if k.startswith("api_") and callable(f)}

_D = f"date '{AS_OF}'"
_CAT = "cat as (select lower(trim(ip_id)) as ip_id, min(category) as category from title_demand where ip_id is not null group by 1)"
_T = f"t as (select ip_id, max(category) as category, min(title) as title, sum(ip_count)::bigint as ip_count from weekly where date = {_D} group by 1)"
_N = "lower(trim(ip_id, E' \\t\\n\\r'))"
_F = {"none": "true", "category": "category = 'Series'", "country": "true", "q": "title ilike '%of%'", "all": "category = 'Movies' and title ilike '%a%'", "limit": "true"}
ORACLE = {
    "api_overview_lists": f"""with {DAILY}, a as (select distinct date from daily where date <= date '{AS_OF}' order by date desc limit 2), n as (select ip_id, value from daily where date = (select max(date) from a)),
  p as (select ip_id, value as p from daily where date = (select min(date) from a)), x as (select ip_id, value, value - coalesce(p, 0) as delta from n left join p using (ip_id)),
  t as (select {_N} as ip_id, min(category) as category from title_demand where ip_id is not null group by 1), r as (select category, x.*, row_number() over (partition by category order by value desc, ip_id) as rn from x join t using (ip_id) where category is not null)
  select * from (select 'movers' as list, ip_id, value, delta from x order by delta desc, ip_id limit 12) union all select category, ip_id, value, delta from r where rn <= 10""",
    "api_streams": """select source as domain, split_part(source, '_', 1) as kind, count(*) as rank_signal, case when max(created_at) >= (select max(created_at) from documents where source is not null) - interval 30 days then 'up' else 'down' end as status
  from documents where source is not null group by 1 order by rank_signal desc, domain limit 300""",
    "api_stream_titles": f"""with {DAILY}, s as (select distinct {_N} as ip_id, created_at::date as date, source from documents where source is not null and ip_id is not null and created_at is not null), m as (select ip_id, max(date) as date from s group by 1),
  n as (select ip_id, date, count(*) as n_sites, string_agg(source, ',' order by source) as sites from s join m using (ip_id, date) group by 1, 2)
  select n.*, coalesce(v.value, 0) as ip_count from n left join (select ip_id, arg_max(value, date) as value from daily group by 1) v using (ip_id)""",
    "api_report": f"""with {DAILY}, {WEEKLY}, t as (select category, ip_id, sum(ip_count)::bigint as value from weekly where date = date '{AS_OF}' group by 1, 2), r as (select *, row_number() over (partition by category order by value desc, ip_id) as rn from t where category is not null)
  select 'cards' as section, 'titles' as label, count(distinct ip_id)::bigint as value from daily where date = date '{AS_OF}' union all select 'cards', 'observers', sum(value)::bigint from daily where date = date '{AS_OF}'
  union all select * from (select 'trend', strftime(date, '%Y-%m-%d'), sum(value)::bigint from daily where date <= date '{AS_OF}' group by date order by date desc limit 30)
  union all select 'top ' || category, ip_id, value from r where rn <= 12 union all select * from (select 'countries', country, sum(ip_count)::bigint as v from weekly where date = date '{AS_OF}' group by 2 order by v desc, country limit 12)""",
    "api_titles_filters": f"with {WEEKLY} " + " union all ".join(
        f"""select '{k}' as asked, ip_id, ip_count from (select ip_id, max(category) as category, min(title) as title, sum(ip_count)::bigint as ip_count from weekly where date = date '{AS_OF}' and {"country = 'US'" if k in ("country", "all") else "true"}
  group by 1 having {w.replace("category =", "max(category) =").replace("title ilike", "min(title) ilike")} order by sum(ip_count) desc, ip_id limit {1000 if k == "limit" else 200})""" for k, w in _F.items()),
    "api_title_info": f"""with {DAILY}, r as (select *, row_number() over (partition by ip_id order by (date = date '{AS_OF}')::int desc, date desc) as rn from daily),
  t as (select {_N} as ip_id, min(title) as title, min(category) as category from title_demand where ip_id is not null group by 1)
  select ip_id, title, category, date, value, date <> date '{AS_OF}' as fallback from r join t using (ip_id) where rn = 1""",
    "api_meta": f"with {WEEKLY} select country, sum(ip_count)::bigint as total, max(date) as latest from weekly group by 1",
    "api_overview": f"""with {DAILY}, {_CAT} select category, sum(case when date = {_D} then value end)::bigint as today, sum(case when date < {_D} then value end)::bigint as before,
  count(distinct ip_id) as n_titles from daily join cat using (ip_id) where date in ({_D}, {_D} - 1) group by 1""",
    "api_titles": f"with {WEEKLY}, {_T} select * from t where category = 'Movies' and title ilike '%the%' order by ip_count desc, ip_id limit 200",
    "api_title": f"""with {WEEKLY}, {_T} select ip_id, country, ip_count from weekly where date = {_D} and ip_id = (select ip_id from t order by ip_count desc, ip_id limit 1)
  order by ip_count desc, country limit 25""",
    "api_title_hashes": f"""with {BRIDGE} select ip_id, hash, seeders, coalesce(nullif(raw_name, ''), title) as name from (select *, row_number() over (partition by ip_id order by seeders desc nulls last, hash) as rn
  from bridge where ip_id is not null) where rn <= 12""",
    "api_countries": f"with {WEEKLY} select country, sum(ip_count)::bigint as total, count(*) as n_titles from weekly where date = {_D} group by 1 order by total desc, country limit 80",
    "api_trends": f"""with {DAILY}, {_CAT}, x as (select date, category, value from daily join cat using (ip_id) where date <= {_D} and date > {_D} - 30),
  a as (select date, unnest(['Anime', 'Movies', 'Series']) as category from (select distinct date from x))
  select a.date, a.category, coalesce(sum(value), 0)::bigint as total from a left join x on x.date = a.date and x.category = a.category group by 1, 2""",
    "api_acestream": """with o as (select infohash, peer_country, max(peer_count) as p, max(bep33_seeders) as s, max(bep33_leechers) as l, min(name) as name from acestream_demand
  where run_ts = (select max(run_ts) from acestream_demand) group by 1, 2)
  select infohash, min(name) as name, max(s) as seeders, max(l) as leechers, sum(p)::bigint as sample, count(*) as n_countries from o group by 1""",
    "api_export": f"with {WEEKLY}, {_T} select title, ip_id, category, ip_count, '{AS_OF}' as date from t order by ip_count desc, ip_id limit 1000",
}
