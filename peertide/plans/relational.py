"""Queries flt*, jn*, set*, srt*: filters, joins, set operations and mutation views, ordered worklists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peertide.functions import rules, text
from peertide.operators import dedup, joins
from peertide.operators.demand import tagged_union
from peertide.plans.common import AS_OF, BRIDGE, DAILY, OBS, WEEKLY, bridge, daily, observations, weekly
from peertide.session import table



def _day() -> Column:
    return F.lit(AS_OF).cast("date")


def flt04_not_in(spark, d):
    """Hashes never observed: an anti join (the key is never null, so NOT IN and NOT EXISTS agree)."""
    return bridge(spark, d).select("hash").join(observations(spark, d).select("hash"), "hash", "left_anti")


def flt05_in_having(spark, d):
    """Hashes of at least 20 distinct observers, or first seen in the last days."""
    o = observations(spark, d)
    busy = o.select("hash", "ip").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    first = o.groupBy("hash").agg(F.min("first_seen").alias("f"))
    wanted = busy.join(first, "hash").where((F.col("n") >= 20) | (F.col("f") >= F.date_sub(_day(), 2))).select("hash")
    return bridge(spark, d).join(wanted, "hash", "left_semi").select("hash", "ip_id", "seeders")


def flt06_exists_pair(spark, d):
    """Dead hashes: observed at some time and not in the last seven days. One pass: a hash is dead if its last day is old or unknown."""
    last = observations(spark, d).groupBy("hash").agg(F.max("last_seen").alias("last"))
    dead = last.where(F.coalesce(F.col("last") < F.date_sub(_day(), 7), F.lit(True))).select("hash")
    return bridge(spark, d).select("hash", "seeders").join(dead, "hash", "left_semi")


def flt08_ilike(spark, d):
    """Titles that contain a text; ASCII letters in either case, % and _ of the text are wildcards."""
    hit = rules.like_any_case(F.col("title"), "%lan_ern%")
    return daily(spark, d).select("ip_id").distinct().join(bridge(spark, d).select("ip_id", "title").distinct(), "ip_id").where(hit)


def flt10_negated(spark, d):
    """Rows that are not both discovered and unclassified; null makes the predicate null and drops the row."""
    h = table(spark, d, "hashes")
    return h.where(~((F.col("source") == "bep51") & (F.col("category") == "Unknown"))).groupBy("source", "category").agg(F.count(F.lit(1)).alias("n"))


def flt13_regex(spark, d):
    """Release names of collections and packs."""
    return table(spark, d, "hashes").where(F.col("raw_name").rlike(r"(?i)\b(collection|discography|complete|files pack)\b")).select("hash", "raw_name").distinct()


def jn02_left(spark, d):
    """Demand rows with the title's category, rows without a hash kept."""
    cat = bridge(spark, d).where("ip_id is not null").groupBy("ip_id").agg(F.min("category").alias("category"), F.count(F.lit(1)).alias("n_hashes"))
    return daily(spark, d).join(cat, "ip_id", "left")


def jn04_full_outer_coalesce(spark, d):
    """Counts of the week by title from two tables, either side may be missing."""
    a = weekly(spark, d).groupBy("date", "ip_id").agg(F.sum("ip_count").alias("by_country"))
    b = daily(spark, d).where(F.col("date") >= "2026-04-14").select("date", "ip_id", F.col("value").alias("by_day"))
    return a.join(b, ["date", "ip_id"], "full").select("date", "ip_id", F.coalesce("by_country", F.lit(0)).alias("by_country"), F.coalesce("by_day", F.lit(0)).alias("by_day"))


def jn09_range_lookup(spark, d):
    """Observers per network block: each observer's number falls into the narrowest of nested ranges."""
    n = table(spark, d, "nation")
    lo = F.col("n_nationkey").cast("bigint") * 20000
    ranges = n.select(lo.alias("lo"), (lo + 19999).alias("hi"), F.col("n_name").alias("label")).unionByName(
        n.select((lo + 5000).alias("lo"), (lo + 5999).alias("hi"), F.concat("n_name", F.lit(" core")).alias("label"))
    )
    ips = observations(spark, d).select("ip").distinct()
    found = joins.range_lookup(ips, F.regexp_extract("ip", r"(\d+)$", 1).cast("bigint"), ranges, width=1000)
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("n_ips"))


def jn11_latest(spark, d):
    """Each title's newest reading not after the day."""
    return joins.latest_before(daily(spark, d), ["ip_id"], "date", _day(), ["value"])


def jn12_date_or_latest(spark, d):
    """The reading of the day, else the newest one."""
    x = daily(spark, d)
    best = F.max(F.struct((F.col("date") == _day()).alias("hit"), "date", "value")).alias("m")
    return x.groupBy("ip_id").agg(best).select("ip_id", F.col("m.date").alias("date"), F.col("m.value").alias("value"))


def jn13_scalar_subq(spark, d):
    """Titles above the mean of their category's totals."""
    w = weekly(spark, d).groupBy("category", "ip_id").agg(F.sum("ip_count").alias("total"))
    mean = w.groupBy("category").agg(F.avg("total").alias("mean"))
    return w.join(mean, "category").where("total > mean").select("category", "ip_id", "total")


def jn14_token_block(spark, d):
    """Catalogue entries that share half of a title's words (rounded down, at least one) with it, by an inverted index; where no entry
    does, those that share any. Little words (the, of) do not count, unless a title has no others. Of several titles of one id the best counts."""
    a = bridge(spark, d).where("ip_id is not null and title is not null").select("ip_id", text.content_words(F.col("title")).alias("t")).distinct().where("size(t) > 0")
    b = table(spark, d, "catalog_info").where("ip is not null").select(F.col("ip_id").alias("catalog_id"), text.words(F.col("ip")).alias("c"))
    half, n = F.expr("greatest(1, size(t) div 2)"), F.size(F.array_intersect("t", "c")).alias("n")
    sets = a.select("t").distinct()
    met = joins.sharing(sets, b, "t", "c").select("t", "catalog_id", n)
    best = met.where(F.size("t") > 3).groupBy("t").agg(F.max("n").alias("best"))  # up to three words any shared one is enough
    least = best.where(F.col("best") < half).select("t")
    hits = met.where(F.col("n") >= half).unionByName(met.join(least, "t"))
    return a.join(hits, "t").groupBy("ip_id", "catalog_id").agg(F.max("n").cast("bigint").alias("n_common"))


def jn15_containment(spark, d):
    """Catalogue titles whose words, numbers and short ones too, all stand in a release name; the one of most words per hash. Little words
    (the, of) are not asked for, unless a title has no others."""
    names = bridge(spark, d).where("raw_name is not null").select(F.col("hash").alias("name_id"), text.words(F.col("raw_name")).alias("words"))
    aliases = table(spark, d, "catalog_info").select(F.col("ip_id").alias("alias_id"), text.content_words(F.col("ip")).alias("words")).where(F.size("words") > 0)
    freq = names.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    c = joins.contained(names, aliases, freq)
    return c.groupBy("name_id").agg(F.min(F.struct((-F.col("n_words")).alias("m"), "alias_id")).alias("w")).select(F.col("name_id").alias("hash"), F.col("w.alias_id").alias("catalog_id"), (-F.col("w.m")).alias("n_words"))


def jn16_movers(spark, d):
    """The twelve titles that rose most against the day before."""
    x = daily(spark, d)
    now = x.where(F.col("date") == _day()).select("ip_id", "value")
    before = x.where(F.col("date") == F.date_sub(_day(), 1)).select("ip_id", F.col("value").alias("p"))
    delta = F.col("value") - F.coalesce("p", F.lit(0))
    return now.join(before, "ip_id", "left").select("ip_id", "value", delta.alias("delta")).orderBy(F.desc("delta"), "ip_id").limit(12)


def set01_union_all(spark, d):
    """Rows of two tables under one shape, with a tag."""
    a = table(spark, d, "title_demand").select("date", "ip_id", "ip_count")
    b = table(spark, d, "title_country").select("date", "ip_id", "ip_count")
    return tagged_union({"day": a, "country": b}).groupBy("src", "date").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("ip_count").between(0, 50000000), F.col("ip_count"))).alias("total"))


def set03_except(spark, d):
    """Titles with demand and without a hash."""
    return daily(spark, d).select("ip_id").distinct().join(bridge(spark, d).where("ip_id is not null").select("ip_id"), "ip_id", "left_anti")


def set05_first_wins(spark, d):
    """One row per hash, the best by seeders and source."""
    return bridge(spark, d)


def set08_upsert_view(spark, d):
    """State of the (hash, ip) upsert."""
    return dedup.latest_view(observations(spark, d), ["hash", "ip"])


def set09_upsert_keep_country(spark, d):
    """State of the upsert that keeps the first country."""
    return dedup.keep_country_view(observations(spark, d), ["hash", "ip"])


def _two_catalogs(spark, d):
    h = table(spark, d, "hashes")
    def side(sources):
        s = h.where(F.col("source").isin(sources)).groupBy("hash")
        return s.agg(F.max("seeders").alias("seeders"), F.min("title").alias("title"), F.array_sort(F.collect_set("source")).alias("trackers"))
    return side(["tpb", "yts", "eztv"]), side(["nyaa", "bitmagnet", "bep51", "tpb"])


def set11_catalog_upsert(spark, d):
    """Merge of two catalogues: largest seeders, first non-blank title, union of trackers."""
    a, b = _two_catalogs(spark, d)
    m = dedup.merge_upsert(a, b, ["hash"], {"seeders": "max", "title": "fill", "trackers": "union"})
    return m.withColumn("trackers", F.array_join("trackers", ","))


def set12_update_if_better(spark, d):
    """Seeders and title change only where seeders grow."""
    a, b = _two_catalogs(spark, d)
    return dedup.update_if_better(a, b, "hash", "seeders", ["title"])


def set14_sentinel(spark, d):
    """Every hash of the worklist has a row: a marker where nothing was seen."""
    o = observations(spark, d).where(F.col("last_seen") == _day()).select("hash", "ip").distinct()
    return bridge(spark, d).select("hash").join(o, "hash", "left").select("hash", F.coalesce("ip", F.lit("_queried_")).alias("ip"))


def set15_retention(spark, d):
    """Rows of the last four days, counted by day."""
    return dedup.retain(observations(spark, d), "last_seen", _day(), 4).groupBy("last_seen").agg(F.count(F.lit(1)).alias("n"))


def set16_cascade_delete(spark, d):
    """What remains of both tables when dead hashes go."""
    dead = flt06_exists_pair(spark, d).select("hash")
    left = observations(spark, d).join(dead, "hash", "left_anti")
    kept = bridge(spark, d).join(dead, "hash", "left_anti")
    return left.agg(F.count(F.lit(1)).alias("n")).select(F.lit("peers").alias("name"), "n").unionByName(kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("hashes").alias("name"), "n"))


def set16_dry_run(spark, d):
    """What a cascade of deletes would take from both tables, without taking it."""
    dead = flt06_exists_pair(spark, d).select("hash")
    rows = observations(spark, d).join(dead, "hash", "left_semi").groupBy("hash").agg(F.count(F.lit(1)).alias("n_peers"))
    return dead.join(rows, "hash", "left").select("hash", F.coalesce("n_peers", F.lit(0)).alias("n_peers"))


#: Hashes that one remap may change; a mapping that changes more is refused as a whole.
REMAP_CAP = 500


def set17_remap(spark, d):
    """Hashes moved along a mapping of ids to the first id of their title and category, as they were (the backup), or one row that says
    the mapping was refused."""
    b = bridge(spark, d).where("ip_id is not null")
    target = b.groupBy("title", "category").agg(F.min("ip_id").alias("new"))
    mapping = b.where("title is not null").select("ip_id", "title", "category").distinct().join(target, ["title", "category"]).where("ip_id != new")
    mapping = mapping.groupBy(F.col("ip_id").alias("old")).agg(F.min("new").alias("new"))
    try:
        out, backup = dedup.remap(b.select("hash", "ip_id"), mapping, "ip_id", most=REMAP_CAP)
    except ValueError:
        return spark.range(1).select(F.lit("refused").alias("status"), F.lit(None).cast("string").alias("hash"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new"))
    moved = backup.select("hash", F.col("ip_id").alias("old")).join(out, "hash")
    return moved.select(F.lit("moved").alias("status"), "hash", "old", F.col("ip_id").alias("new"))


def srt01_nulls_last(spark, d):
    """The 50 best hashes, unknown seeders last."""
    return bridge(spark, d).orderBy(F.desc_nulls_last("seeders"), F.desc_nulls_last("title"), "hash").limit(50).select("hash", "seeders", "title")


def srt02_three_key(spark, d):
    """The next 100 hashes to visit: by seeders, then new ones, then by last activity."""
    last = observations(spark, d).where(F.col("last_seen") >= F.date_sub(_day(), 30)).groupBy("hash").agg(F.max("last_seen").alias("last"), F.min("first_seen").alias("first"))
    w = bridge(spark, d).join(last, "hash", "left")
    new = F.coalesce(F.col("first") >= F.date_sub(_day(), 2), F.lit(False))
    return w.orderBy(F.desc(F.coalesce("seeders", F.lit(0))), F.desc(new), F.desc_nulls_last("last"), "hash").limit(100).select("hash", "seeders", "last")


def srt03_rotation(spark, d):
    """Of the 200 best-seeded hashes the 40 visited longest ago."""
    pool = bridge(spark, d).orderBy(F.desc_nulls_last("seeders"), "hash").limit(200).select("hash", "seeders")
    last = observations(spark, d).groupBy("hash").agg(F.max("last_seen").alias("visit"))
    return pool.join(last, "hash", "left").orderBy(F.asc_nulls_first("visit"), F.desc_nulls_last("seeders"), "hash").limit(40)


def srt05_orders(spark, d):
    """The first 20 titles of the day in each order a caller may ask for."""
    from peertide.plans import serve

    parts = [serve.titles(spark, d, sort=k, limit=20).select(F.lit(k).alias("sort"), "ip_id", "ip_count") for k in serve.SORTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def srt08_offset(spark, d):
    """Worker shares by round: the share of a hash moves on by one with each round."""
    share = F.conv(F.substring("hash", 1, 8), 16, 10).cast("bigint")
    rounds = F.explode(F.sequence(F.lit(0), F.lit(3)))
    return bridge(spark, d).select("hash", rounds.alias("round")).groupBy("round", F.pmod(share + F.col("round"), F.lit(4)).alias("worker")).agg(F.count(F.lit(1)).alias("n"))


def srt09_cap(spark, d):
    """The 300 hashes with most observers of the day: ordered by their number, then cut."""
    o = observations(spark, d).where(F.col("last_seen") == _day()).select("hash", "ip").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("num"))
    return o.orderBy(F.desc("num"), "hash").limit(300)


def srt08_stride(spark, d):
    """Each worker's share of the hashes: a hash of the key in place of a global row number, which would sort all rows."""
    share = F.pmod(F.conv(F.substring("hash", 1, 8), 16, 10).cast("bigint"), F.lit(4)).alias("worker")
    return bridge(spark, d).groupBy(share).agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("first_hash"))


QUERIES = {k: f for k, f in globals().items() if k[:3] in ("flt", "jn0", "jn1", "set", "srt") and callable(f)}

_D = f"date '{AS_OF}'"
_W = "regexp_split_to_array(lower({c}), '[^a-z0-9]+')"
_SET = "list_distinct(list_filter(" + _W + ", lambda x: x <> ''))"
_LITTLE = ", ".join(f"'{w}'" for w in text.LITTLE_WORDS)
#: Words without little ones, all of them where there are no others.
_CONTENT = f"case when len(list_filter({_SET}, lambda x: x not in ({_LITTLE}))) > 0 then list_filter({_SET}, lambda x: x not in ({_LITTLE})) else {_SET} end"
_SIDES = """a as (select hash, max(seeders) as seeders, min(title) as title, list_sort(list_distinct(list(source))) as t from hashes where source in ('tpb','yts','eztv') group by 1),
  b as (select hash, max(seeders) as seeders, min(title) as title, list_sort(list_distinct(list(source))) as t from hashes where source in ('nyaa','bitmagnet','bep51','tpb') group by 1)"""
_DEAD = f"dead as (select hash, seeders from bridge where hash in (select hash from obs group by 1 having coalesce(max(last_seen) < {_D} - 7, true)))"
ORACLE = {
    "flt04_not_in": f"with {OBS}, {BRIDGE} select hash from bridge where hash not in (select hash from obs)",
    "flt05_in_having": f"""with {OBS}, {BRIDGE} select hash, ip_id, seeders from bridge where hash in (select hash from obs group by hash
  having count(distinct ip) >= 20 or min(first_seen) >= {_D} - 2)""",
    "flt06_exists_pair": f"with {OBS}, {BRIDGE}, {_DEAD} select * from dead",
    "flt08_ilike": f"with {BRIDGE}, {DAILY} select distinct ip_id, title from bridge where ip_id in (select ip_id from daily) and translate(title, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') like '%lan_ern%'",
    "flt10_negated": "select source, category, count(*) as n from hashes where not (source = 'bep51' and category = 'Unknown') group by 1, 2",
    "flt13_regex": r"select distinct hash, raw_name from hashes where regexp_matches(raw_name, '(?i)\b(collection|discography|complete|files pack)\b')",
    "jn02_left": f"""with {BRIDGE}, {DAILY}, c as (select ip_id, min(category) as category, count(*) as n_hashes from bridge where ip_id is not null group by 1)
  select daily.*, c.category, c.n_hashes from daily left join c using (ip_id)""",
    "jn04_full_outer_coalesce": f"""with {WEEKLY}, {DAILY}, a as (select date, ip_id, sum(ip_count)::bigint as n from weekly group by 1, 2),
  b as (select date, ip_id, value as n from daily where date >= date '2026-04-14')
  select date, ip_id, coalesce(a.n, 0) as by_country, coalesce(b.n, 0) as by_day from a full join b using (date, ip_id)""",
    "jn09_range_lookup": f"""with {OBS}, r as (select n_nationkey * 20000 as lo, n_nationkey * 20000 + 19999 as hi, n_name as label from nation
  union all select n_nationkey * 20000 + 5000, n_nationkey * 20000 + 5999, n_name || ' core' from nation),
  v as (select distinct ip, try_cast(regexp_extract(ip, '([0-9]+)$', 1) as bigint) as v from obs),
  m as (select ip, label, row_number() over (partition by ip order by hi - lo, lo) as rn from v join r on v between lo and hi)
  select label, count(*) as n_ips from v left join (select * from m where rn = 1) using (ip) group by 1""",
    "jn11_latest": f"with {DAILY} select ip_id, max(date) as date, arg_max(value, date) as value from daily where date <= {_D} group by 1",
    "jn12_date_or_latest": f"""with {DAILY}, r as (select *, row_number() over (partition by ip_id order by (date = {_D})::int desc, date desc) as rn from daily)
  select ip_id, date, value from r where rn = 1""",
    "jn13_scalar_subq": f"""with {WEEKLY}, w as (select category, ip_id, sum(ip_count)::bigint as total from weekly group by 1, 2)
  select * from w where total > (select avg(total) from w x where x.category = w.category)""",
    "jn14_token_block": f"""with {BRIDGE}, a as (select distinct ip_id, {_CONTENT.format(c="title")} as t from bridge where ip_id is not null and title is not null),
  b as (select ip_id as catalog_id, {_SET.format(c="ip")} as c from catalog_info where ip is not null),
  m as (select t, catalog_id, len(list_intersect(t, c)) as n from (select distinct t from a where len(t) > 0) x, b where len(list_intersect(t, c)) > 0),
  k as (select *, max(n) over (partition by t) as best from m)
  select ip_id, catalog_id, max(n) as n_common from a join k using (t) where n >= greatest(1, len(t) // 2) or best < greatest(1, len(t) // 2) group by 1, 2""",
    "jn15_containment": f"""with {BRIDGE}, n as (select hash, {_SET.format(c="raw_name")} as w from bridge where raw_name is not null),
  a as (select ip_id as catalog_id, {_CONTENT.format(c="ip")} as w from catalog_info where ip is not null),
  c as (select hash, catalog_id, len(a.w) as n_words, row_number() over (partition by hash order by len(a.w) desc, catalog_id) as rn from n join a on len(a.w) > 0 and list_has_all(n.w, a.w))
  select hash, catalog_id, n_words from c where rn = 1""",
    "jn16_movers": f"""with {DAILY} select a.ip_id, a.value, a.value - coalesce(b.value, 0) as delta from daily a left join daily b on a.ip_id = b.ip_id and b.date = {_D} - 1
  where a.date = {_D} order by delta desc, ip_id limit 12""",
    "set01_union_all": """select src, date, count(*) as n, sum(case when ip_count between 0 and 50000000 then ip_count end)::bigint as total from
  (select 'day' as src, date, ip_count from title_demand union all select 'country', date, ip_count from title_country) group by 1, 2""",
    "set03_except": f"with {BRIDGE}, {DAILY} select ip_id from daily except select ip_id from bridge",
    "set05_first_wins": f"with {BRIDGE} select * from bridge",
    "set08_upsert_view": f"""with {OBS}, w as (select hash, ip, country, row_number() over (partition by hash, ip order by last_seen desc, ingested_at desc, country desc) as rn from obs
  where last_seen is not null and country is not null)
  select o.hash, o.ip, min(o.first_seen) as first_seen, max(o.last_seen) as last_seen, any_value(w.country) as country from obs o
  left join w on w.hash = o.hash and w.ip = o.ip and w.rn = 1 group by 1, 2""",
    "set09_upsert_keep_country": f"""with {OBS}, w as (select hash, ip, country, row_number() over (partition by hash, ip order by first_seen, ingested_at, country) as rn from obs
  where first_seen is not null and country is not null)
  select o.hash, o.ip, max(o.last_seen) as last_seen, any_value(w.country) as country from obs o left join w on w.hash = o.hash and w.ip = o.ip and w.rn = 1 group by 1, 2""",
    "set11_catalog_upsert": f"""with {_SIDES} select hash, greatest(a.seeders, b.seeders) as seeders, coalesce(nullif(a.title, ''), b.title) as title,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(a.t, []), coalesce(b.t, [])))), ',') as trackers from a full join b using (hash)""",
    "set12_update_if_better": f"""with {_SIDES} select hash, case when a.hash is null or coalesce(b.seeders > coalesce(a.seeders, 0), false) then b.seeders else a.seeders end as seeders,
  case when a.hash is null or coalesce(b.seeders > coalesce(a.seeders, 0), false) then b.title else a.title end as title from a full join b using (hash)""",
    "set14_sentinel": f"with {OBS}, {BRIDGE} select b.hash, coalesce(o.ip, '_queried_') as ip from bridge b left join (select distinct hash, ip from obs where last_seen = {_D}) o using (hash)",
    "set15_retention": f"with {OBS} select last_seen, count(*) as n from obs where last_seen >= {_D} - 4 group by 1",
    "set16_cascade_delete": f"""with {OBS}, {BRIDGE}, {_DEAD} select 'peers' as name, count(*) as n from obs where hash not in (select hash from dead)
  union all select 'hashes', count(*) from bridge where hash not in (select hash from dead)""",
    "set16_dry_run": f"""with {OBS}, {BRIDGE}, {_DEAD}, k as (select hash, count(*) as n from obs group by 1) select hash, coalesce(n, 0) as n_peers from dead left join k using (hash)""",
    "set17_remap": f"""with {BRIDGE}, t as (select title, category, min(ip_id) as new from bridge where ip_id is not null group by 1, 2),
  m as (select ip_id as old, min(new) as new from bridge join t using (title, category) where ip_id <> new group by 1), c as (select hash, old, new from bridge join m on old = ip_id)
  select 'moved' as status, hash, old, new from c where (select count(*) from c) <= {REMAP_CAP} union all select 'refused', null, null, null where (select count(*) from c) > {REMAP_CAP}""",
    "srt05_orders": f"with {WEEKLY}, t as (select ip_id, min(title) as title, sum(ip_count)::bigint as ip_count from weekly where date = {_D} group by 1) " + " union all ".join(
        f"select '{k}' as sort, ip_id, ip_count from (select * from t order by {o}, ip_id limit 20)" for k, o in (("ip", "ip_count desc"), ("ip_asc", "ip_count"), ("title", "title nulls last"), ("title_desc", "title desc nulls last"))),
    "srt08_offset": f"with {BRIDGE} select r as round, (('0x' || substr(hash, 1, 8))::bigint + r) % 4 as worker, count(*) as n from bridge, range(0, 4) t(r) group by 1, 2",
    "srt09_cap": f"with {OBS} select hash, count(distinct ip) as num from obs where last_seen = {_D} group by 1 order by num desc, hash limit 300",
    "srt01_nulls_last": f"with {BRIDGE} select hash, seeders, title from bridge order by seeders desc nulls last, title desc nulls last, hash limit 50",
    "srt02_three_key": f"""with {OBS}, {BRIDGE}, l as (select hash, max(last_seen) as last, min(first_seen) as f from obs where last_seen >= {_D} - 30 group by 1)
  select hash, seeders, last from bridge left join l using (hash) order by coalesce(seeders, 0) desc, coalesce(f >= {_D} - 2, false) desc, last desc nulls last, hash limit 100""",
    "srt03_rotation": f"""with {OBS}, {BRIDGE}, p as (select hash, seeders from bridge order by seeders desc nulls last, hash limit 200)
  select hash, seeders, visit from p left join (select hash, max(last_seen) as visit from obs group by 1) using (hash) order by visit nulls first, seeders desc nulls last, hash limit 40""",
    "srt08_stride": f"with {BRIDGE} select ('0x' || substr(hash, 1, 8))::bigint % 4 as worker, count(*) as n, min(hash) as first_hash from bridge group by 1",
}
