"""Queries for the remaining single computations: projections, small aggregates, rankings, scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from peertide.functions import text
from peertide.operators import joins, quality
from peertide.plans.common import AS_OF, BRIDGE, DAILY, OBS, WEEKLY, bridge, daily, observations, weekly
from peertide.session import table


def _day() -> Column:
    return F.lit(AS_OF).cast("date")


def _imdb(c: Column) -> Column:
    """tt and at least seven digits; zero, blanks and words are null."""
    n = F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"^\s*(?:tt)?0*([1-9][0-9]{5,})\s*$", 1)
    return F.when(n != "", F.concat(F.lit("tt"), F.when(F.length(n) < 7, F.lpad(n, 7, "0")).otherwise(n)))


def prj05_map_fallback(spark, d):
    """Label of a category through a map, unknown ones through the prefix of the id."""
    m = F.create_map(*[F.lit(x) for kv in (("Movies", "film"), ("Series", "series"), ("Anime", "anime")) for x in kv])
    return bridge(spark, d).select("hash", F.coalesce(F.element_at(m, F.col("category")), F.split("ip_id", "-")[0], F.lit("none")).alias("kind"))


def prj08_measure_switch(spark, d):
    """A measure chosen by parameter stands in for the count."""
    measure = {"all": "ip_count", "dht": "ip_count_dht", "harv": "ip_count_harv", "pex": "ip_count_pex"}["dht"]
    return table(spark, d, "title_country").select("date", "ip_id", F.col(measure).alias("ip_count")).groupBy("date").agg(F.sum("ip_count").alias("total"))


def prj12_imdb(spark, d):
    return table(spark, d, "hashes").select("imdb_id", _imdb(F.col("imdb_id")).alias("imdb")).distinct()


def prj14_first_nonempty(spark, d):
    return bridge(spark, d).select("hash", F.coalesce(F.nullif(F.trim("title"), F.lit("")), "raw_name").alias("name"))


def flt03_relative(spark, d):
    """Activity of the last 2, 5 and 30 days in one scan."""
    ago = F.datediff(_day(), F.col("last_seen"))
    o = observations(spark, d).where((F.col("last_seen") >= F.date_sub(_day(), 30)) & (F.col("last_seen") <= _day()))
    return o.groupBy("src").agg(*[F.count_if(ago <= n).alias(f"last_{n}") for n in (2, 5, 30)])


def flt12_null_tolerant(spark, d):
    return observations(spark, d).where(F.col("first_seen").isNull() | (F.col("first_seen") <= F.date_sub(_day(), 14))).groupBy("src").agg(F.count(F.lit(1)).alias("n"))


def flt16_shape(spark, d):
    return table(spark, d, "hashes").agg(F.count_if(F.col("hash").rlike("^[0-9a-f]{40}$")).alias("good"), F.count(F.lit(1)).alias("n"))


def flt17_thresholds(spark, d):
    a = table(spark, d, "acestream_demand").where("availability >= 0.5 and peer_count >= 5")
    return a.groupBy("owner").agg(F.count_distinct("infohash").alias("n_channels"), F.count(F.lit(1)).alias("n"))


def agg08_dc_share(spark, d):
    """Data-centre share per day with a guard against division by zero."""
    t = table(spark, d, "title_demand").where("ip_count between 0 and 50000000")
    s = t.groupBy("date").agg(F.sum("dc_ip_count").alias("dc"), F.sum("ip_count").alias("total"))
    return s.withColumn("share", F.when(F.col("total") > 0, F.col("dc") / F.col("total")).otherwise(0.0))


def agg16_examples(spark, d):
    """Counts by category with the first eight names."""
    b = bridge(spark, d).where("raw_name is not null")
    rank = F.row_number().over(Window.partitionBy("category").orderBy("raw_name", "hash"))
    ex = b.withColumn("rn", rank).where("rn <= 8").groupBy("category").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "raw_name"))), lambda x: x["raw_name"]), "|").alias("examples"))
    return b.groupBy("category").agg(F.count(F.lit(1)).alias("n")).join(ex, "category")


def agg18_wrong_year(spark, d):
    """Share of a title's dated releases more than two years from its median year, the mean of the middle two where their number is even."""
    y = bridge(spark, d).where("ip_id is not null").select("ip_id", text.first_year(F.col("raw_name")).alias("y")).where("y is not null")
    y = y.groupBy("ip_id", "y").agg(F.count(F.lit(1)).alias("k"))
    m = y.groupBy("ip_id").agg(F.percentile("y", 0.5, F.col("k")).alias("median"), F.sum("k").alias("n")).where("n >= 3")
    far = F.when(F.abs(F.col("y") - F.col("median")) > 2, F.col("k")).otherwise(0)
    return y.join(m, "ip_id").groupBy("ip_id").agg((F.sum(far) / F.max("n")).alias("wrong"), F.max("n").alias("n"))


def agg20_channel_rollup(spark, d):
    """Per run and channel: channel values by maximum, sample by sum, countries as a map in text."""
    a = table(spark, d, "acestream_demand").groupBy("run_ts", "infohash", "peer_country").agg(F.max("peer_count").alias("p"), F.max("bep33_leechers").alias("l"))
    geo = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("peer_country", F.lit("?")).alias("c"), "p"))), lambda x: F.concat(x["c"], F.lit("="), x["p"].cast("string"))), ",")
    return a.groupBy("run_ts", "infohash").agg(F.max("l").alias("leechers"), F.sum("p").alias("sample"), geo.alias("geo"))


def agg22_country_rank(spark, d):
    w = weekly(spark, d).groupBy("date", "country").agg(F.sum("ip_count").alias("total"))
    return w.withColumn("rank", F.row_number().over(Window.partitionBy("date").orderBy(F.desc("total"), "country")))


def agg25_nunique(spark, d):
    """Distinct values of several columns: one aggregate per column over distinct rows, not one expand over all rows."""
    o = observations(spark, d)
    parts = [o.select(F.lit(c).alias("name"), F.col(c).cast("string").alias("v")).where("v is not null").distinct() for c in ("hash", "ip", "country", "src")]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def win05_projection(spark, d):
    """A day's total projected from the part of the day gone: at least a tenth of it."""
    part = F.greatest(F.lit(0.10), (F.hour("ingested_at") * 60 + F.minute("ingested_at")) / 1440.0)
    o = observations(spark, d).where(F.col("last_seen") == _day())
    return o.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.max(part).alias("part")).withColumn("projected", F.col("n") / F.col("part"))


def win10_top_countries(spark, d):
    """The five best countries of each of the ten largest titles of the day."""
    w = weekly(spark, d).where(F.col("date") == _day())
    top = w.groupBy("ip_id").agg(F.sum("ip_count").alias("total")).orderBy(F.desc("total"), "ip_id").limit(10)
    rank = F.row_number().over(Window.partitionBy("ip_id").orderBy(F.desc("ip_count"), "country"))
    return w.join(top, "ip_id").withColumn("rank", rank).where("rank <= 5").select("ip_id", "country", "ip_count", "rank")


def win16_partial(spark, d):
    """Days with a mark on the one that is not over."""
    return daily(spark, d).groupBy("date").agg(F.sum("value").alias("total")).withColumn("is_partial", F.col("date") >= _day())


def win17_contribution(spark, d):
    """Share of each source and what the union adds to the best of them."""
    t = table(spark, d, "title_country").where("ip_count is not null").groupBy("date").agg(*[F.sum(c).alias(c) for c in ("ip_count", "ip_count_dht", "ip_count_harv", "ip_count_pex")])
    lift = F.greatest((F.col("ip_count") - F.col("ip_count_harv")) / F.col("ip_count"), F.lit(0.0))
    return t.select("date", (F.col("ip_count_dht") / F.col("ip_count")).alias("dht"), (F.col("ip_count_pex") / F.col("ip_count")).alias("pex"), lift.alias("lift"))


def srt04_bool_first(spark, d):
    a = table(spark, d, "acestream_demand").where("availability is not null").groupBy("infohash").agg(F.min("owner").alias("owner"), F.max("availability").alias("availability"))
    return a.orderBy(F.col("owner") == "Other", F.desc("availability"), "infohash").limit(10)


def set06_setdefault(spark, d):
    """First title seen per imdb number, by first_seen and hash."""
    h = table(spark, d, "hashes").select(_imdb(F.col("imdb_id")).alias("imdb"), "title", "first_seen", "hash").where("imdb is not null and title is not null")
    return h.groupBy("imdb").agg(F.min(F.struct("first_seen", "hash", "title")).alias("m")).select("imdb", F.col("m.title").alias("title"))


def set07_drop_duplicates(spark, d):
    return table(spark, d, "title_demand").select("date", "ip_id", "ip_count").distinct().groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def set10_visits(spark, d):
    """Visit ledger per hash: last visit and what it yielded."""
    v = observations(spark, d).where("last_seen is not null").groupBy("hash", "last_seen").agg(F.count(F.lit(1)).alias("n"))
    return v.groupBy("hash").agg(F.max(F.struct("last_seen", "n")).alias("m")).select("hash", F.col("m.last_seen").alias("last_visit"), F.col("m.n").alias("last_yield"))


def set13_fill_only(spark, d):
    """imdb numbers filled from other hashes of the title, never replaced."""
    b = bridge(spark, d).where("ip_id is not null").select("hash", "ip_id", _imdb(F.col("imdb_id")).alias("imdb"))
    known = b.where("imdb is not null").groupBy("ip_id").agg(F.min("imdb").alias("known"))
    return b.join(known, "ip_id", "left").select("hash", F.coalesce("imdb", "known").alias("imdb"))


def fn_s07_camel(spark, d):
    return table(spark, d, "acestream_demand").select("name", F.regexp_replace(F.regexp_replace("name", " ", ""), "(?<=[a-z])(?=[A-Z])", " ").alias("spaced")).distinct()


def fn_s06_strip_group(spark, d):
    s = F.regexp_replace(F.regexp_replace("raw_name", r"\.(mkv|mp4|avi|zip)$", ""), r"-[A-Za-z0-9]+$", "")
    return table(spark, d, "hashes").where("raw_name is not null").select("raw_name", s.alias("name")).distinct()


def fn_s20_id_parts(spark, d):
    b = bridge(spark, d).where("ip_id is not null").select("ip_id").distinct()
    return b.select("ip_id", F.split_part("ip_id", F.lit("-"), F.lit(1)).alias("family"), F.split_part("ip_id", F.lit("-"), F.lit(2)).alias("rest"))


def fn_s34_ipv4(spark, d):
    """Addresses from token numbers to dotted form and back."""
    n = F.regexp_extract("ip", r"([0-9]+)$", 1).cast("bigint")
    o = observations(spark, d).select(n.alias("n")).where("n is not null").distinct()
    part = lambda k: F.pmod(F.floor(F.col("n") / k), F.lit(256)).cast("string")
    dotted = F.concat_ws(".", part(16777216), part(65536), part(256), part(1))
    return o.select("n", dotted.alias("address")).select("n", "address", text.ipv4_number(F.col("address")).alias("back"))


def fn_m02_round(spark, d):
    """Half-even rounding."""
    return weekly(spark, d).groupBy("country").agg(F.bround(F.avg("ip_count"), 1).alias("mean"))


def fn_m04_tiers(spark, d):
    s = F.coalesce("seeders", F.lit(0))
    tier = F.when(s >= 1000, 30).when(s >= 100, 20).when(s >= 10, 12).otherwise(6)
    return bridge(spark, d).groupBy(tier.alias("seconds")).agg(F.count(F.lit(1)).alias("n"))


def fn_a02_overlap(spark, d):
    """Share of a title's words in the release name and the other way round."""
    b = bridge(spark, d).where("raw_name is not null and title is not null").select("hash", text.words(F.col("raw_name")).alias("r"), text.words(F.col("title")).alias("t")).where("size(r) > 0 and size(t) > 0")
    n = F.size(F.array_intersect("r", "t"))
    return b.select("hash", (n / F.size("t")).alias("forward"), (n / F.size("r")).alias("reverse"))


def fn_j01_json(spark, d):
    """All records inside documents, parsed: a row for each record of a text."""
    j = F.explode(F.regexp_extract_all("text", F.lit(r'(\{"ip_id": [^}]*\})'), F.lit(1)))
    p = table(spark, d, "documents").select("doc_id", j.alias("j")).select("doc_id", F.from_json("j", "ip_id string, year int, seeders long, dc boolean").alias("j")).where("j.ip_id is not null")
    return p.select("doc_id", "j.ip_id", "j.year", "j.seeders", "j.dc")


def er11_audit(spark, d):
    """Titles of at least three hashes whose names agree with the title in under 60 % of them."""
    b = bridge(spark, d).where("ip_id is not null and raw_name is not null and title is not null")
    hit = F.size(F.array_intersect(text.words(F.col("raw_name")), text.words(F.col("title")))) * 2 >= F.size(text.words(F.col("title")))
    g = b.groupBy("ip_id").agg(F.avg(hit.cast("double")).alias("agreement"), F.count(F.lit(1)).alias("n"))
    return g.where("n >= 3 and agreement < 0.6")


def er14_aliases(spark, d):
    """Alias table: every spelling of a title, once per normal form."""
    b = bridge(spark, d).where("ip_id is not null and title is not null").select("ip_id", F.col("title").alias("alias"), text.title_key(F.col("title")).alias("alias_norm")).where("alias_norm != ''")
    return b.groupBy("ip_id", "alias_norm").agg(F.min("alias").alias("alias"))


def er16_two_pass(spark, d):
    """Exact titles first, the rest by their words sorted."""
    t = bridge(spark, d).where("title is not null").select("title").distinct()
    c = table(spark, d, "catalog_info").where("ip is not null")
    one = t.join(c.groupBy(F.col("ip").alias("title")).agg(F.min("ip_id").alias("ip_id")), "title").select("title", "ip_id", F.lit(1).alias("pass"))
    key = lambda x: F.array_join(F.array_sort(text.words(F.col(x))), " ")
    rest = t.join(one.select("title"), "title", "left_anti").select("title", key("title").alias("k"))
    two = rest.join(c.select(key("ip").alias("k"), "ip_id").groupBy("k").agg(F.min("ip_id").alias("ip_id")), "k").select("title", "ip_id", F.lit(2).alias("pass"))
    return one.unionByName(two)


def dq04_hint(spark, d):
    """Titles whose twelve best-seeded names are at least four and at most two different ones."""
    b = bridge(spark, d).where("ip_id is not null and raw_name is not null")
    rank = F.row_number().over(Window.partitionBy("ip_id").orderBy(F.desc_nulls_last("seeders"), "hash"))
    g = b.withColumn("rn", rank).where("rn <= 12").groupBy("ip_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.lower("raw_name")).alias("names"))
    return g.where("n >= 4 and names <= 2")


def fn_s04_clean(spark, d):
    return table(spark, d, "hashes").where("raw_name is not null").select("raw_name", text.clean_release(F.col("raw_name")).alias("name")).distinct()


def fn_s12_word_checks(spark, d):
    """Names without letters and names that were not cut well, per category."""
    w = text.words(F.col("raw_name"))
    b = bridge(spark, d).where("raw_name is not null").select("category", text.has_letters(w).alias("letters"), text.degraded(w).alias("degraded"))
    return b.groupBy("category").agg(F.count_if("letters").alias("n_letters"), F.count_if("degraded").alias("n_degraded"))


def fn_s16_ambiguous(spark, d):
    return table(spark, d, "catalog_info").where("ip is not null").groupBy(text.ambiguous(F.col("ip")).alias("ambiguous")).agg(F.count(F.lit(1)).alias("n"))


def fn_s21_family(spark, d):
    """Hashes whose id and category name different kinds of work."""
    fam = text.id_family(F.col("ip_id"))
    kind = F.when(F.col("category") == "Movies", "film").when(F.col("category") == "Series", "series").when(F.col("category") == "Anime", "anime")
    return bridge(spark, d).groupBy(fam.alias("family"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def fn_s23_country_label(spark, d):
    """Countries with a label from a dimension table, their code where it has none (nations stand in for the dimension)."""
    labels = table(spark, d, "nation").select(F.upper(F.substring("n_name", 1, 2)).alias("code"), "n_name").groupBy("code").agg(F.min("n_name").alias("label"))
    c = weekly(spark, d).groupBy("country").agg(F.sum("ip_count").alias("total"))
    return c.join(labels, F.col("country") == F.col("code"), "left").select("country", F.coalesce("label", "country").alias("label"), "total")


def fn_s30_format(spark, d):
    """Counts as text with thousands marked."""
    return weekly(spark, d).groupBy("date").agg(F.format_number(F.sum("ip_count"), 0).alias("total"))


def dq03_in_top(spark, d):
    """Decoy titles among the hundred largest of the day."""
    top = weekly(spark, d).where(F.col("date") == _day()).groupBy("ip_id").agg(F.sum("ip_count").alias("total")).orderBy(F.desc("total"), "ip_id").limit(100)
    return quality.decoys(bridge(spark, d), "ip_id", "raw_name").select("ip_id").join(top.select("ip_id"), "ip_id", "left_semi")


def er13_reverse(spark, d):
    """Catalogue entries and titles that cover each other's words: half of the title, three tenths of the entry. Little words (the, of)
    do not count, unless a title has no others. A pair that covers half meets in the rarest words of the title: all but as many as half less one."""
    t = bridge(spark, d).where("title is not null").select("title").distinct().withColumn("t", text.content_words(F.col("title"))).where("size(t) > 0")
    c = table(spark, d, "catalog_info").where("ip is not null").select("ip_id", text.words(F.col("ip")).alias("c"), text.content_words(F.col("ip")).alias("k")).distinct()
    frequency = c.select(F.explode("c").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    t = joins.rarest_first(t, "title", "t", frequency).withColumn("probe", F.expr("slice(t, 1, size(t) - ceil(size(t) / 2) + 1)"))
    pair = joins.sharing(t, c, "probe", "c")
    entry = F.when(F.forall("t", lambda x: x.isin(*text.LITTLE_WORDS)), F.col("c")).otherwise(F.col("k"))
    n = F.size(F.array_intersect(F.col("t"), entry))
    return pair.where((n / F.size("t") >= 0.5) & (n / F.size(entry) >= 0.3)).select("title", "ip_id")


def er09_reason(spark, d):
    """Why a hash got no title: the first reason that holds, in order."""
    n = F.lower("raw_name")
    reason = (
        F.when(F.col("raw_name").isNull(), "no name")
        .when(n.rlike("collection|discography|files pack"), "collection")
        .when(n.rlike("^[0-9a-f]{32,40}$"), "hash for a name")
        .when(F.col("title").isNull() & text.first_year(F.col("raw_name")).isNull(), "no title and no year")
        .when(F.col("title").isNull(), "no title")
        .when(F.col("ip_id").isNull(), "no id")
    )
    return bridge(spark, d).groupBy(F.coalesce(reason, F.lit("matched")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {k: f for k, f in globals().items() if k[:3] in ("prj", "flt", "agg", "win", "srt", "set", "fn_", "er0", "er1", "dq0") and callable(f)}

_D = f"date '{AS_OF}'"
_IM = r"case when regexp_extract(lower(coalesce(imdb_id, '')), '^\s*(?:tt)?0*([1-9][0-9]{5,})\s*$', 1) <> '' then 'tt' || lpad(regexp_extract(lower(coalesce(imdb_id, '')), '^\s*(?:tt)?0*([1-9][0-9]{5,})\s*$', 1), greatest(7, length(regexp_extract(lower(coalesce(imdb_id, '')), '^\s*(?:tt)?0*([1-9][0-9]{5,})\s*$', 1)))::int, '0') end"
_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> ''))"
_SOME = f"list_filter({_WORDS}, lambda x: x not in ({', '.join(repr(w) for w in text.LITTLE_WORDS)}))"
_CONTENT = f"case when len({_SOME}) > 0 then {_SOME} else {_WORDS} end"
_KEY = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({c}), '&[a-z]+;|&#[0-9]+;', ' ', 'g'), '\b(19|20)[0-9]{{2}}\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), '\s+', ' ', 'g'))"
_YEAR = "nullif(regexp_extract(raw_name, '(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)', 1), '')::int"
_INTER = f"len(list_intersect({_WORDS.format(c='raw_name')}, {_WORDS.format(c='title')}))"
ORACLE = {
    "prj05_map_fallback": f"with {BRIDGE} select hash, coalesce(case category when 'Movies' then 'film' when 'Series' then 'series' when 'Anime' then 'anime' end, split_part(ip_id, '-', 1), 'none') as kind from bridge",
    "prj08_measure_switch": "select date, sum(ip_count_dht)::bigint as total from title_country group by 1",
    "prj12_imdb": f"select distinct imdb_id, {_IM} as imdb from hashes",
    "prj14_first_nonempty": f"with {BRIDGE} select hash, coalesce(nullif(trim(title), ''), raw_name) as name from bridge",
    "flt03_relative": f"""with {OBS} select src, count(*) filter ({_D} - last_seen <= 2) as last_2, count(*) filter ({_D} - last_seen <= 5) as last_5, count(*) as last_30 from obs
  where last_seen between {_D} - 30 and {_D} group by 1""",
    "flt12_null_tolerant": f"with {OBS} select src, count(*) as n from obs where first_seen is null or first_seen <= {_D} - 14 group by 1",
    "flt16_shape": "select count(*) filter (regexp_full_match(hash, '[0-9a-f]{40}')) as good, count(*) as n from hashes",
    "flt17_thresholds": "select owner, count(distinct infohash) as n_channels, count(*) as n from acestream_demand where availability >= 0.5 and peer_count >= 5 group by 1",
    "agg08_dc_share": "select date, sum(dc_ip_count)::bigint as dc, sum(ip_count)::bigint as total, case when sum(ip_count) > 0 then sum(dc_ip_count)::double / sum(ip_count) else 0 end as share from title_demand where ip_count between 0 and 50000000 group by 1",
    "agg16_examples": f"""with {BRIDGE}, r as (select *, row_number() over (partition by category order by raw_name, hash) as rn from bridge where raw_name is not null)
  select category, count(*) as n, string_agg(raw_name, '|' order by rn) filter (rn <= 8) as examples from r group by 1""",
    "agg18_wrong_year": f"""with {BRIDGE}, y as (select ip_id, {_YEAR} as y from bridge where ip_id is not null), m as (select ip_id, median(y) as m, count(y) as n from y where y is not null group by 1)
  select ip_id, avg((abs(y - m) > 2)::int::double) as wrong, any_value(n) as n from y join m using (ip_id) where y is not null and n >= 3 group by 1""",
    "agg20_channel_rollup": """with a as (select run_ts, infohash, peer_country, max(peer_count) as p, max(bep33_leechers) as l from acestream_demand group by 1, 2, 3)
  select run_ts, infohash, max(l) as leechers, sum(p)::bigint as sample, string_agg(coalesce(peer_country, '?') || '=' || p, ',' order by coalesce(peer_country, '?'), p) as geo from a group by 1, 2""",
    "agg22_country_rank": f"with {WEEKLY}, w as (select date, country, sum(ip_count)::bigint as total from weekly group by 1, 2) select *, row_number() over (partition by date order by total desc, country) as rank from w",
    "agg25_nunique": f"""with {OBS} select 'hash' as name, count(distinct hash) as n from obs union all select 'ip', count(distinct ip) from obs union all select 'country', count(distinct country) from obs
  union all select 'src', count(distinct src) from obs""",
    "win05_projection": f"""with {OBS}, p as (select src, count(*) as n, max(greatest(0.10::double, (hour(ingested_at) * 60 + minute(ingested_at)) / 1440.0::double)) as part from obs where last_seen = {_D} group by 1)
  select *, n / part as projected from p""",
    "win10_top_countries": f"""with {WEEKLY}, t as (select ip_id, sum(ip_count) as total from weekly where date = {_D} group by 1 order by total desc, ip_id limit 10)
  select * from (select ip_id, country, ip_count, row_number() over (partition by ip_id order by ip_count desc, country) as rank from weekly where date = {_D} and ip_id in (select ip_id from t)) where rank <= 5""",
    "win16_partial": f"with {DAILY} select date, sum(value)::bigint as total, date >= {_D} as is_partial from daily group by 1",
    "win17_contribution": """select date, sum(ip_count_dht)::double / sum(ip_count) as dht, sum(ip_count_pex)::double / sum(ip_count) as pex, greatest((sum(ip_count) - sum(ip_count_harv))::double / sum(ip_count), 0) as lift
  from title_country where ip_count is not null group by 1""",
    "srt04_bool_first": "select infohash, min(owner) as owner, max(availability) as availability from acestream_demand where availability is not null group by 1 order by min(owner) = 'Other', max(availability) desc, infohash limit 10",
    "set06_setdefault": f"with x as (select {_IM} as imdb, title, first_seen, hash from hashes where title is not null), r as (select *, row_number() over (partition by imdb order by first_seen, hash, title) as rn from x where imdb is not null) select imdb, title from r where rn = 1",
    "set07_drop_duplicates": "select date, count(*) as n from (select distinct date, ip_id, ip_count from title_demand) group by 1",
    "set10_visits": f"with {OBS}, v as (select hash, last_seen, count(*) as n from obs where last_seen is not null group by 1, 2) select hash, max(last_seen) as last_visit, arg_max(n, last_seen) as last_yield from v group by 1",
    "set13_fill_only": f"with {BRIDGE}, b as (select hash, ip_id, {_IM} as imdb from bridge where ip_id is not null) select hash, coalesce(imdb, min(imdb) over (partition by ip_id)) as imdb from b",
    "fn_s06_strip_group": r"select distinct raw_name, regexp_replace(regexp_replace(raw_name, '\.(mkv|mp4|avi|zip)$', ''), '-[A-Za-z0-9]+$', '') as name from hashes where raw_name is not null",
    "fn_s07_camel": "select distinct name, regexp_replace(replace(name, ' ', ''), '([a-z])([A-Z])', '\\1 \\2', 'g') as spaced from acestream_demand",
    "fn_s20_id_parts": f"with {BRIDGE} select distinct ip_id, split_part(ip_id, '-', 1) as family, split_part(ip_id, '-', 2) as rest from bridge where ip_id is not null",
    "fn_s34_ipv4": f"""with {OBS}, n as (select distinct try_cast(regexp_extract(ip, '([0-9]+)$', 1) as bigint) as n from obs) select n, (n // 16777216 % 256) || '.' || (n // 65536 % 256) || '.' || (n // 256 % 256) || '.' || (n % 256) as address, n as back
  from n where n is not null""",
    "fn_m02_round": f"with {WEEKLY} select country, round_even(avg(ip_count), 1) as mean from weekly group by 1",
    "fn_m04_tiers": f"with {BRIDGE} select case when coalesce(seeders, 0) >= 1000 then 30 when coalesce(seeders, 0) >= 100 then 20 when coalesce(seeders, 0) >= 10 then 12 else 6 end as seconds, count(*) as n from bridge group by 1",
    "fn_a02_overlap": f"""with {BRIDGE} select hash, {_INTER}::double / len({_WORDS.format(c="title")}) as forward, {_INTER}::double / len({_WORDS.format(c="raw_name")}) as reverse from bridge
  where raw_name is not null and title is not null and len({_WORDS.format(c="title")}) > 0 and len({_WORDS.format(c="raw_name")}) > 0""",
    "fn_j01_json": """with j as (select doc_id, unnest(regexp_extract_all(text, '(\\{"ip_id": [^}]*\\})', 1)) as j from documents)
  select doc_id, j->>'ip_id' as ip_id, (j->>'year')::int as year, (j->>'seeders')::bigint as seeders, (j->>'dc')::boolean as dc from j where j->>'ip_id' is not null""",
    "er11_audit": f"""with {BRIDGE}, g as (select ip_id, avg(({_INTER} * 2 >= len({_WORDS.format(c="title")}))::int::double) as agreement, count(*) as n from bridge where ip_id is not null and raw_name is not null and title is not null group by 1)
  select * from g where n >= 3 and agreement < 0.6""",
    "er14_aliases": f"with {BRIDGE} select ip_id, {_KEY.format(c='title')} as alias_norm, min(title) as alias from bridge where ip_id is not null and title is not null and {_KEY.format(c='title')} <> '' group by 1, 2",
    "er16_two_pass": f"""with {BRIDGE}, t as (select distinct title from bridge where title is not null), o as (select title, min(ip_id) as ip_id from t join catalog_info on ip = title group by 1),
  k as (select array_to_string(list_sort({_WORDS.format(c="ip")}), ' ') as k, min(ip_id) as ip_id from catalog_info where ip is not null group by 1)
  select title, ip_id, 1 as pass from o union all select title, ip_id, 2 from t join k on k.k = array_to_string(list_sort({_WORDS.format(c="title")}), ' ') where title not in (select title from o)""",
    "dq04_hint": f"""with {BRIDGE}, r as (select *, row_number() over (partition by ip_id order by seeders desc nulls last, hash) as rn from bridge where ip_id is not null and raw_name is not null)
  select ip_id, count(*) as n, count(distinct lower(raw_name)) as names from r where rn <= 12 group by 1 having count(*) >= 4 and count(distinct lower(raw_name)) <= 2""",
    "fn_s04_clean": r"""select distinct raw_name, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(raw_name), '[._]+', ' ', 'g'), '^\s*\[[^\]]*\]\s*(-\s*)?', ''),
  '(\(|\[|\b(19|20)[0-9]{2}\b|\bs[0-9]{2}|\b[0-9]+x[0-9]{2}|\bseason\b|\bepisode\b|\b[0-9]{3,4}p\b).*$', ''), '\s+', ' ', 'g')) as name from hashes where raw_name is not null""",
    "fn_s12_word_checks": f"""with {BRIDGE}, w as (select category, {_WORDS.format(c="raw_name")} as w from bridge where raw_name is not null)
  select category, count(*) filter (len(list_filter(w, lambda x: not regexp_full_match(x, '[0-9]+'))) > 0) as n_letters,
  count(*) filter (len(list_filter(w, lambda x: length(x) >= 15 and regexp_matches(x, '[0-9]'))) > 0) as n_degraded from w group by 1""",
    "fn_s16_ambiguous": f"""select length(trim(ip)) <= 3 or len(list_filter({_WORDS.format(c="ip")}, lambda x: x not in ({", ".join(f"'{w}'" for w in text.STOP_WORDS)}))) = 0 as ambiguous, count(*) as n
  from catalog_info where ip is not null group by 1""",
    "fn_s21_family": f"""with {BRIDGE} select case when split_part(ip_id, '-', 1) in ('film', 'series', 'anime') then split_part(ip_id, '-', 1) end as family,
  case category when 'Movies' then 'film' when 'Series' then 'series' when 'Anime' then 'anime' end as kind, count(*) as n from bridge group by 1, 2""",
    "fn_s23_country_label": f"""with {WEEKLY}, l as (select upper(n_name[1:2]) as code, min(n_name) as label from nation group by 1)
  select country, coalesce(label, country) as label, total from (select country, sum(ip_count)::bigint as total from weekly group by 1) left join l on code = country""",
    "fn_s30_format": f"with {WEEKLY} select date, format('{{:,}}', sum(ip_count)::bigint) as total from weekly group by 1",
    "dq03_in_top": f"""with {BRIDGE}, {WEEKLY}, n as (select ip_id, raw_name, count(*) as n from bridge where ip_id is not null and raw_name is not null group by 1, 2),
  g as (select ip_id from n group by 1 having sum(n) >= 5 and max(n) >= 4 and count(*) / sum(n) < 0.5)
  select ip_id from g where ip_id in (select ip_id from (select ip_id, sum(ip_count) as total from weekly where date = {_D} group by 1 order by total desc, ip_id limit 100))""",
    "er13_reverse": f"""with {BRIDGE}, t as (select title, {_CONTENT.format(c="title")} as t, len({_SOME.format(c="title")}) = 0 as little from (select distinct title from bridge where title is not null)),
  c as (select distinct ip_id, {_WORDS.format(c="ip")} as c, {_CONTENT.format(c="ip")} as k from catalog_info where ip is not null),
  p as (select title, ip_id, t, case when little then c else k end as e from t, c where len(t) > 0)
  select title, ip_id from p where len(list_intersect(t, e)) / len(t) >= 0.5 and len(list_intersect(t, e)) / len(e) >= 0.3""",
    "er09_reason": f"""with {BRIDGE} select case when raw_name is null then 'no name' when regexp_matches(lower(raw_name), 'collection|discography|files pack') then 'collection'
  when regexp_matches(lower(raw_name), '^[0-9a-f]{{32,40}}$') then 'hash for a name' when title is null and {_YEAR} is null then 'no title and no year' when title is null then 'no title' when ip_id is null then 'no id'
  else 'matched' end as reason, count(*) as n from bridge group by 1""",
}
