"""Queries for rules about names, ids and titles, small projections and scalar functions, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from peertide.functions import rules, text
from peertide.functions.ids import norm_id
from peertide.operators import identity
from peertide.plans.common import AS_OF, BRIDGE, DAILY, NORM_ID, OBS, bridge, daily, observations
from peertide.session import table

#: Media groups of channels for fn_s19_owner: ordered, the first with a keyword in the name decides.
OWNERS = [("Arena", ("sport", "arena")), ("Herald", ("news", "info", "herald")), ("Cinema", ("film", "cinema", "movie"))]
BRAND = ("sky", "Skyline", ("AU", "BR"))


def _day() -> Column:
    return F.lit(AS_OF).cast("date")


# --- filters


def flt09_prefix(spark, d):
    """Titles that are the first two words of a catalogue entry or begin with them: whole words, so a join on the words and no LIKE."""
    p = table(spark, d, "catalog_info").where("ip is not null").select(F.array_join(F.slice(F.split(F.lower(F.trim("ip")), " "), 1, 2), " ").alias("prefix")).distinct()
    t = bridge(spark, d).where("title is not null").select("title").distinct()
    return t.join(p.where("prefix != ''"), F.array_join(F.slice(F.split(F.lower("title"), " "), 1, 2), " ") == F.col("prefix")).select("title", "prefix")


def flt11_not_active(spark, d):
    """Hashes of the worklist without those of the running scan (seen on the day)."""
    active = observations(spark, d).where(F.col("last_seen") == _day()).select("hash")
    return bridge(spark, d).where("seeders > 0").select("hash", "seeders").join(active, "hash", "left_anti")


def flt13_packs(spark, d):
    """Release names that hold several works."""
    return table(spark, d, "hashes").where(rules.is_pack(F.col("raw_name"))).select("hash", "raw_name").distinct()


def flt14_adult(spark, d):
    """Release names by whether a listed word refuses them; the list is a parameter, here words of the test tables."""
    flag = rules.is_adult(F.col("raw_name"), ("lantern", "garden", "xxx"))
    return table(spark, d, "hashes").where("raw_name is not null").select("hash", flag.alias("refused")).distinct()


def flt15_labels(spark, d):
    """Catalogue entries and page headings by whether they are navigation."""
    h = table(spark, d, "documents").select(F.explode(text.html_texts(F.col("text"), "[a-z0-9]+")).alias("heading"))
    all_ = h.unionByName(table(spark, d, "catalog_info").select(F.col("ip").alias("heading"))).where("heading is not null")
    return all_.groupBy(rules.is_page_label(F.col("heading")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def flt19_hot_set(spark, d):
    """The hot set: well-seeded hashes that are new."""
    return bridge(spark, d).join(observations(spark, d).groupBy("hash").agg(F.min("first_seen").alias("first")), "hash").where((F.coalesce("seeders", F.lit(0)) >= 50) & (F.col("first") >= F.date_sub(_day(), 30))).select("hash", "seeders", "first")


# --- projections


def prj01_reorder(spark, d):
    return table(spark, d, "title_country").where(F.col("date") == _day()).select("ip_id", "country", "date", "ip_count")


def prj02_rename(spark, d):
    t = table(spark, d, "title_country").where(F.col("date") == _day())
    return t.withColumnsRenamed({"ip_count": "n_ips", "ip_id": "title_id"}).select("title_id", "country", "n_ips")


def prj04_backfill(spark, d):
    """Missing counts are zero and missing texts blank."""
    t = table(spark, d, "title_country").select("date", "ip_id", "title", "ip_count").where(F.col("date") == _day())
    return t.na.fill(0, ["ip_count"]).na.fill("", ["ip_id", "title"])


def prj06_overwrite(spark, d):
    """A category is overwritten where the id says otherwise."""
    b = bridge(spark, d)
    said = F.when(F.col("ip_id").startswith("anime-"), "Anime").when(F.col("ip_id").startswith("series-"), "Series").when(F.col("ip_id").startswith("film-"), "Movies")
    return b.select("hash", F.when((F.col("category") == "Unknown") & said.isNotNull(), said).otherwise(F.col("category")).alias("category"))


def prj08_measures(spark, d):
    """Totals of a day under each measure that may stand in for the count."""
    t = table(spark, d, "title_country")
    parts = [t.groupBy("date").agg(F.sum(c).alias("total")).select(F.lit(k).alias("measure"), "date", "total") for k, c in (("all", "ip_count"), ("dht", "ip_count_dht"), ("harv", "ip_count_harv"), ("pex", "ip_count_pex"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def prj09_null_column(spark, d):
    return table(spark, d, "catalog_info").select("ip_id", F.lit(None).cast("string").alias("anime_id"), F.lit(None).cast("int").alias("year"))


def prj10_display_name(spark, d):
    """A name put together from its parts where there is none."""
    parts = F.concat_ws(" ", F.initcap(F.split_part("ip_id", F.lit("-"), F.lit(1))), F.split_part("ip_id", F.lit("-"), F.lit(2)))
    return bridge(spark, d).where("ip_id is not null").select("hash", F.coalesce(F.nullif(F.trim("title"), F.lit("")), parts).alias("name"))


# --- text, dates, numbers


def fn_s05_listing(spark, d):
    return table(spark, d, "hashes").where("raw_name is not null").select("raw_name", rules.listing_title(F.col("raw_name")).alias("name")).distinct()


def fn_s14_guard_tokens(spark, d):
    return table(spark, d, "catalog_info").where("ip is not null").select("ip_id", F.array_join(rules.guard_tokens(F.col("ip")), " ").alias("tokens"))


def fn_s18_rules(spark, d):
    """Category by ordered rules, adult names first."""
    h = table(spark, d, "hashes").select("hash", "raw_name").distinct()
    return h.select("hash", rules.category_by_rules(F.col("raw_name")).alias("guess"))


def fn_s19_owner(spark, d):
    """Channels by media group: brand with its exceptions, then ordered keywords."""
    a = table(spark, d, "acestream_demand").select("infohash", "name", "ch_country").distinct()
    return a.groupBy(rules.owner(F.col("name"), F.col("ch_country"), OWNERS, BRAND).alias("group")).agg(F.count_distinct("infohash").alias("n"))


def fn_s24_datacenter(spark, d):
    """Names of organisations with a keyword, or numbers in a set, count as data centres (channels stand in for organisations)."""
    a = table(spark, d, "acestream_demand").select("name", F.col("infohash").isNull().alias("x"), F.pmod(F.length("name"), F.lit(7)).alias("asn")).distinct()
    flag = text.organisation_is_datacenter(F.col("name"), ("cloud", "news", "server")) | F.col("asn").isin(3, 5)
    return a.groupBy(flag.alias("datacenter")).agg(F.count_distinct("name").alias("n"))


def fn_s26_links(spark, d):
    """The first two links of a page that stay on its site, relative ones made absolute."""
    p = table(spark, d, "documents").where(F.col("text").contains("<a href"))
    return p.select("doc_id", F.array_join(rules.same_site_links(F.col("text"), "wiki.example"), " ").alias("links"))


def fn_s29_poster(spark, d):
    """Addresses of pictures from paths, whole addresses and blanks."""
    path = F.when(F.col("seeders") % 4 == 0, F.lit(None)).when(F.col("seeders") % 4 == 1, F.concat(F.lit("/"), "hash")).when(F.col("seeders") % 4 == 2, F.concat(F.lit("https://a.example/"), "hash")).otherwise(F.col("hash"))
    return bridge(spark, d).select("hash", rules.poster_url(path).alias("poster"))


def fn_s31_hash(spark, d):
    return table(spark, d, "peers").select("hash").distinct().select("hash", text.base32_hex("hash").alias("decoded"))


def fn_d02_cutoff(spark, d):
    return daily(spark, d).where(F.col("date") >= F.date_sub(_day(), 5)).groupBy("date").agg(F.count(F.lit(1)).alias("n")).withColumn("yesterday", F.date_sub("date", 1))


def fn_d03_iso(spark, d):
    """Days and times of loads as ISO text."""
    t = table(spark, d, "title_demand").where("loaded_at is not null")
    return t.select(F.to_date("loaded_at").cast("string").alias("day"), F.date_format("loaded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("stamp")).groupBy("day").agg(F.min("stamp").alias("first"), F.max("stamp").alias("last"))


def fn_d04_year(spark, d):
    return table(spark, d, "catalog_info").select("ip_id", F.substring("release_date", 1, 4).try_cast("int").alias("year"))


def fn_d05_grace(spark, d):
    """Loads in the grace window: in the first 45 minutes the day before is still open."""
    minute = F.hour("loaded_at") * 60 + F.minute("loaded_at")
    t = table(spark, d, "title_demand").where("loaded_at is not null")
    return t.groupBy((minute < 45).alias("grace"), F.when(minute < 45, F.date_sub(F.to_date("loaded_at"), 1)).otherwise(F.to_date("loaded_at")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def fn_m03_clamp(spark, d):
    return table(spark, d, "acestream_demand").groupBy("owner").agg(F.sum(F.greatest(F.lit(0), F.least(F.lit(1000), F.col("bep33_leechers")))).alias("clamped"))


def fn_m05_safe_int(spark, d):
    """Numbers out of texts, 0 where there are none."""
    return table(spark, d, "catalog_info").groupBy(F.coalesce(F.col("release_date").try_cast("int"), F.lit(0)).alias("number")).agg(F.count(F.lit(1)).alias("n"))


def fn_a04_ordered_unique(spark, d):
    return bridge(spark, d).where("raw_name is not null").select("hash", F.array_join(F.array_distinct(text.word_list(F.col("raw_name"))), " ").alias("words"))


# --- sets and aggregates


def agg23_pass_summary(spark, d):
    """Peers of the day by country, category and title, where there are any."""
    o = observations(spark, d).where(F.col("last_seen") == _day()).select("hash", "ip", "country").distinct()
    n = o.groupBy("hash", "country").agg(F.count(F.lit(1)).alias("n")).join(bridge(spark, d).select("hash", "category", "title"), "hash")
    level = F.explode(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).alias("value")) for c in ("country", "category", "title")]))
    return n.select("n", level.alias("l")).where("l.value is not null").groupBy(F.col("l.level").alias("level"), F.col("l.value").alias("value")).agg(F.sum("n").alias("n"))


def agg27_recount(spark, d):
    """Observers by country after each observer got one country: the one it was seen in most often, ties by code."""
    o = observations(spark, d).where("country is not null")
    one = o.groupBy("ip", "country").agg(F.count(F.lit(1)).alias("k")).groupBy("ip").agg(F.min(F.struct((-F.col("k")).alias("k"), "country")).alias("m"))
    return one.groupBy(F.col("m.country").alias("country")).agg(F.count(F.lit(1)).alias("n_ips"))


def set04_done(spark, d):
    """Hashes already done today: those of the day's log (well-seeded ones stand in for it) and those with a row in peers, markers
    included."""
    log = bridge(spark, d).where("seeders >= 200").select("hash")
    seen = table(spark, d, "peers").where(F.col("last_seen") == _day()).select(F.lower("hash").alias("hash"))
    return log.union(seen).distinct()


# --- ids


def _meta(spark, d):
    """(ip_id, title, imdb, anime, resolved, unmapped) of the ids of the feed; the catalogue resolves an imdb number, an anime id resolves to
    itself."""
    imdb = F.nullif(F.regexp_extract(F.lower(F.coalesce("imdb_id", F.lit(""))), r"([0-9]{7,})", 1), F.lit(""))
    t = table(spark, d, "title_demand").where("ip_id is not null").select(norm_id("ip_id").alias("ip_id"), text.squash(F.col("title")).alias("title"), imdb.alias("imdb"), F.nullif(F.trim("anime_id"), F.lit("")).alias("anime"))
    h = table(spark, d, "hashes").where("ip_id is not null").select(norm_id("ip_id").alias("ip_id"), text.squash(F.col("title")).alias("title"), imdb.alias("imdb"), F.lit(None).cast("string").alias("anime"))
    t = t.unionByName(h).groupBy("ip_id").agg(F.min("title").alias("title"), F.max("imdb").alias("imdb"), F.max("anime").alias("anime"))
    c = table(spark, d, "catalog_info").select("ip_id", "imdb_id").select(F.col("ip_id").alias("cid"), imdb.alias("imdb")).where("imdb is not null").groupBy("imdb").agg(F.min("cid").alias("cid"))
    return t.join(c, "imdb", "left").select("ip_id", "title", "imdb", "anime", F.coalesce("cid", F.concat(F.lit("anime-"), "anime")).alias("resolved")).withColumn("unmapped", F.col("resolved").isNull().cast("int"))


def er04_canon_v2(spark, d):
    """(old, new) by imdb number, else by anime id; equal titles with different numbers stay apart. Ids that nothing resolves fold
    into the one resolved id of their title, if there is exactly one and the kinds of work agree."""
    return identity.canonical_by_authority(_meta(spark, d), rules.compatible)


def er05_merged(spark, d):
    """Observers per canonical id and country: sets are united along the map before they are counted."""
    m = er04_canon_v2(spark, d)
    b = bridge(spark, d).where("ip_id is not null").select("hash", "ip_id").join(m, F.col("ip_id") == F.col("old"), "left").select("hash", F.coalesce("new", "ip_id").alias("ip_id"))
    o = observations(spark, d).select("hash", "ip", "country").join(b, "hash")
    return o.select("ip_id", "country", "ip").distinct().groupBy("ip_id", "country").agg(F.count(F.lit(1)).alias("n_ips"))


def er06_name_guard(spark, d):
    """Hashes whose release name may stand for their title: years of films, whole short titles, shares of longer ones."""
    year = table(spark, d, "catalog_info").where("ip is not null").groupBy(text.squash(F.col("ip")).alias("key")).agg(F.min(F.substring("release_date", 1, 4).try_cast("int")).alias("year"))
    b = bridge(spark, d).where("raw_name is not null and title is not null").withColumn("key", text.squash(F.col("title"))).join(year, "key", "left")
    return b.select("hash", "year", rules.stands_for(F.col("raw_name"), F.col("title"), F.col("year"), F.col("category")).alias("passes"))


def er08_diverges(spark, d):
    """Catalogue entries reached by a title's rarest shared word, and whether the two diverge."""
    t = bridge(spark, d).where("title is not null").select("title").distinct()
    c = table(spark, d, "catalog_info").where("ip is not null").select("ip_id", F.col("ip").alias("entry"))
    n = c.select(F.explode(rules.guard_tokens(F.col("entry"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    rare = t.select("title", F.explode(rules.guard_tokens(F.col("title"))).alias("w")).join(n, "w").groupBy("title").agg(F.min(F.struct("n", "w")).alias("m")).select("title", F.col("m.w").alias("w"))
    pair = rare.join(c.select("ip_id", "entry", F.explode(rules.guard_tokens(F.col("entry"))).alias("w")), "w")
    return pair.select("title", "ip_id", rules.diverges(F.col("title"), F.col("entry")).alias("diverges"))


def er11_wrong(spark, d):
    """Titles of at least three hashes with their agreement and share of wrong years, the least consistent first."""
    b = bridge(spark, d).where("ip_id is not null and raw_name is not null and title is not null")
    hit = F.size(F.array_intersect(text.words(F.col("raw_name")), text.words(F.col("title")))) * 2 >= F.size(text.words(F.col("title")))
    g = b.groupBy("ip_id").agg(F.avg(hit.cast("double")).alias("agreement"), F.count(F.lit(1)).alias("n"))
    return g.where("n >= 3 and agreement < 0.95")


def dq04_repeated(spark, d):
    """Of each title with at least four names among its twelve best-seeded hashes: how many different ones."""
    b = bridge(spark, d).where("ip_id is not null and raw_name is not null")
    rank = F.row_number().over(Window.partitionBy("ip_id").orderBy(F.desc_nulls_last("seeders"), "hash"))
    g = b.withColumn("rn", rank).where("rn <= 12").groupBy("ip_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.lower("raw_name")).alias("names"))
    return g.where("n >= 4").withColumn("hint", F.col("names") <= 2)


QUERIES = {k: f for k, f in globals().items() if k[:3] in ("flt", "prj", "fn_", "agg", "set", "er0", "er1", "dq0") and callable(f)}

_D = f"date '{AS_OF}'"
_LIST = "list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> '')"
_IN = lambda ws: ", ".join(f"'{w}'" for w in ws)
_GUARD = f"""list_sort(list_distinct(list_transform(list_filter({_LIST}, lambda w: length(w) >= 2 and w not in ({_IN((*rules.GUARD_STOP, *rules.GUARD_SUFFIX))})
  and not regexp_full_match(w, '[0-9]+p?|s[0-9]+|e[0-9]+|s[0-9]+e[0-9]+')), lambda w: case when length(w) > 3 and ends_with(w, 's') then w[:-2] else w end)))"""
_IMDB = "nullif(regexp_extract(lower(coalesce(imdb_id, '')), '([0-9]{7,})', 1), '')"
_SQUASH = r"trim(regexp_replace(lower({c}), '\s+', ' ', 'g'))"
_FAMILY = "case when split_part(lower({c}), '-', 1) in ('film', 'series', 'anime') then split_part(lower({c}), '-', 1) end"
_META = f"""c as (select {_IMDB} as imdb, min(ip_id) as cid from catalog_info where {_IMDB} is not null group by 1),
  f as (select {NORM_ID} as ip_id, min({_SQUASH.format(c="title")}) as title, max({_IMDB}) as imdb, max(nullif(trim(anime_id), '')) as anime
    from (select ip_id, title, imdb_id, anime_id from title_demand union all select ip_id, title, imdb_id, null from hashes) where ip_id is not null group by 1),
  meta as (select ip_id, title, f.imdb, anime, coalesce(cid, 'anime-' || anime) as resolved from f left join c on c.imdb = f.imdb),
  hard as (select ip_id as old, first_value(ip_id) over (partition by case when imdb is not null then 'i' || imdb else 'a' || anime end order by resolved is null, ip_id) as new from meta where imdb is not null or anime is not null),
  lone as (select title, min(resolved) as resolved from meta where resolved is not null and title is not null group by 1 having count(distinct resolved) = 1),
  home as (select resolved, min(ip_id) as ip_id from meta where resolved is not null group by 1),
  soft as (select m.ip_id as old, coalesce(h.new, home.ip_id) as new from meta m join lone using (title) join home on home.resolved = lone.resolved left join hard h on h.old = home.ip_id
    where m.imdb is null and m.anime is null and m.resolved is null),
  canon as (select old, new from hard where old <> new union all select old, new from soft where old <> new
    and coalesce({_FAMILY.format(c="old")} = {_FAMILY.format(c="new")} or ({_FAMILY.format(c="old")} = 'series' and {_FAMILY.format(c="new")} = 'anime'), true))"""
_RULE = "case when raw_name is null then 'Unknown' when regexp_matches(lower(raw_name), '\\b(" + "|".join(rules.ADULT_WORDS) + ")\\b') then 'Adult' " + " ".join(f"when regexp_matches(lower(raw_name), '{r}') then '{k}'" for k, r in rules.CATEGORY_RULES) + " else 'Unknown' end"
_OWNER = "case when starts_with(n, 'sky ') or contains(n, ' sky ') then case when cc in ('AU', 'BR') then 'Other' else 'Skyline' end " + " ".join("when " + " or ".join(f"contains(n, '{k}')" for k in keys) + f" then '{who}'" for who, keys in OWNERS) + " else 'Other' end"
_WORDS = f"list_distinct({_LIST})"
_CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(raw_name), '[._]+', ' ', 'g'), '^\s*\[[^\]]*\]\s*(-\s*)?', ''),
  '(\(|\[|\b(19|20)[0-9]{2}\b|\bs[0-9]{2}|\b[0-9]+x[0-9]{2}|\bseason\b|\bepisode\b|\b[0-9]{3,4}p\b).*$', ''), '\s+', ' ', 'g'))"""
_PLAIN = "regexp_replace({c}, '[''’]', '', 'g')"
ORACLE = {
    "flt09_prefix": f"""with {BRIDGE}, p as (select distinct array_to_string(string_split(lower(trim(ip)), ' ')[1:2], ' ') as prefix from catalog_info where ip is not null)
  select distinct title, prefix from bridge join p on array_to_string(string_split(lower(title), ' ')[1:2], ' ') = prefix where title is not null and prefix <> ''""",
    "flt11_not_active": f"with {OBS}, {BRIDGE} select hash, seeders from bridge where seeders > 0 and hash not in (select hash from obs where last_seen = {_D})",
    "flt13_packs": "select distinct hash, raw_name from hashes where regexp_matches(replace(lower(raw_name), 'criterion collection', 'criterion'), '" + "|".join(rules.PACKS) + "')",
    "flt14_adult": "select distinct hash, regexp_matches(lower(raw_name), '\\b(lantern|garden|xxx)\\b') as refused from hashes where raw_name is not null",
    "flt15_labels": f"""select trim(regexp_replace(lower(h), '[^a-z0-9]+', ' ', 'g')) in ({_IN(rules.PAGE_LABELS)}) as label, count(*) as n from
  (select unnest(list_distinct(regexp_extract_all(text, '<[a-z0-9]+[^>]*>([^<]*)</[a-z0-9]+>', 1))) as h from documents union all select ip from catalog_info) where h is not null group by 1""",
    "flt19_hot_set": f"with {OBS}, {BRIDGE}, f as (select hash, min(first_seen) as first from obs group by 1) select hash, seeders, first from bridge join f using (hash) where coalesce(seeders, 0) >= 50 and first >= {_D} - 30",
    "prj01_reorder": f"select ip_id, country, date, ip_count from title_country where date = {_D}",
    "prj02_rename": f"select ip_id as title_id, country, ip_count as n_ips from title_country where date = {_D}",
    "prj04_backfill": f"select date, coalesce(ip_id, '') as ip_id, coalesce(title, '') as title, coalesce(ip_count, 0) as ip_count from title_country where date = {_D}",
    "prj06_overwrite": f"""with {BRIDGE} select hash, case when category = 'Unknown' and split_part(ip_id, '-', 1) in ('anime', 'series', 'film')
  then case split_part(ip_id, '-', 1) when 'anime' then 'Anime' when 'series' then 'Series' else 'Movies' end else category end as category from bridge""",
    "prj08_measures": " union all ".join(f"select '{k}' as measure, date, sum({c})::bigint as total from title_country group by 2" for k, c in (("all", "ip_count"), ("dht", "ip_count_dht"), ("harv", "ip_count_harv"), ("pex", "ip_count_pex"))),
    "prj09_null_column": "select ip_id, null::varchar as anime_id, null::int as year from catalog_info",
    "prj10_display_name": f"""with {BRIDGE} select hash, coalesce(nullif(trim(title), ''), upper(ip_id[1:1]) || split_part(ip_id, '-', 1)[2:] || ' ' || split_part(ip_id, '-', 2)) as name from bridge where ip_id is not null""",
    "fn_s05_listing": r"""select distinct raw_name, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw_name, '[._\s][Ss][0-9]{1,2}[Ee][0-9]{1,2}.*$', '', 'g'),
  '(?i)[._\s\[(]+(480p|720p|1080p|2160p|4k|bluray|blu-ray|bdrip|brrip|web-dl|webrip|hdtv|hdrip|dvdrip|x264|x265|hevc|xvid).*$', '', 'g'), '[._]+', ' ', 'g'), '\s*[\[(][^\])]*[\])]\s*$', '', 'g'), '\s+-\w+$', '', 'g'),
  '\s*\([0-9]{4}\)\s*', '', 'g'))) as name from hashes where raw_name is not null""",
    "fn_s14_guard_tokens": f"select ip_id, array_to_string({_GUARD.format(c='ip')}, ' ') as tokens from catalog_info where ip is not null",
    "fn_s18_rules": f"select hash, {_RULE} as guess from (select distinct hash, raw_name from hashes)",
    "fn_s19_owner": f"""with a as (select distinct infohash, lower(coalesce(name, '')) as n, replace(split_part(upper(coalesce(ch_country, '')), ',', 1), 'UK', 'GB') as cc from acestream_demand)
  select {_OWNER} as "group", count(distinct infohash) as n from a group by 1""",
    "fn_s24_datacenter": """select coalesce(regexp_matches(lower(name), 'cloud|news|server'), false) or length(name) % 7 in (3, 5) as datacenter, count(distinct name) as n from acestream_demand group by 1""",
    "fn_s26_links": """with l as (select doc_id, list_filter(list_transform(list_filter(regexp_extract_all(text, '<a href="([^"]+)"', 1), lambda x, i: list_position(regexp_extract_all(text, '<a href="([^"]+)"', 1), x) = i), lambda x: case when starts_with(x, '/') then 'https://wiki.example' || x else x end),
  lambda x: starts_with(x, 'https://wiki.example/') or starts_with(x, 'http://wiki.example/')) as l from documents where contains(text, '<a href'))
  select doc_id, array_to_string(l[1:2], ' ') as links from l""",
    "fn_s29_poster": f"""with {BRIDGE} select hash, case when seeders % 4 = 0 then null when seeders % 4 = 1 then 'https://image.example/t/p/w342/' || hash when seeders % 4 = 2 then 'https://a.example/' || hash
  else 'https://image.example/t/p/w342/' || hash end as poster from bridge""",
    "fn_s31_hash": "select distinct hash, case when regexp_full_match(lower(hash), '[0-9a-f]{40}') then lower(hash) end as decoded from peers",
    "fn_d02_cutoff": f"with {DAILY} select date, count(*) as n, date - 1 as yesterday from daily where date >= {_D} - 5 group by 1",
    "fn_d03_iso": """select strftime(loaded_at, '%Y-%m-%d') as day, min(strftime(loaded_at, '%Y-%m-%dT%H:%M:%SZ')) as first, max(strftime(loaded_at, '%Y-%m-%dT%H:%M:%SZ')) as last from title_demand where loaded_at is not null group by 1""",
    "fn_d04_year": "select ip_id, try_cast(release_date[1:4] as int) as year from catalog_info",
    "fn_d05_grace": "with t as (select loaded_at, hour(loaded_at) * 60 + minute(loaded_at) < 45 as grace from title_demand where loaded_at is not null) select grace, case when grace then loaded_at::date - 1 else loaded_at::date end as day, count(*) as n from t group by 1, 2",
    "fn_m03_clamp": "select owner, sum(greatest(0, least(1000, bep33_leechers)))::bigint as clamped from acestream_demand group by 1",
    "fn_m05_safe_int": "select coalesce(case when regexp_full_match(trim(release_date), '[+-]?[0-9]+') then try_cast(release_date as int) end, 0) as number, count(*) as n from catalog_info group by 1",
    "fn_a04_ordered_unique": f"""with {BRIDGE}, w as (select hash, {_LIST.format(c="raw_name")} as l from bridge where raw_name is not null)
  select hash, array_to_string(list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda x: list_position(l, x[1]) = x[2]), lambda x: x[1]), ' ') as words from w""",
    "agg23_pass_summary": f"""with {OBS}, {BRIDGE}, n as (select hash, country, count(distinct ip) as n from obs where last_seen = {_D} group by 1, 2), j as (select n, country, category, title from n join bridge using (hash))
  select 'country' as level, country as value, sum(n)::bigint as n from j where country is not null group by 2 union all select 'category', category, sum(n)::bigint from j where category is not null group by 2
  union all select 'title', title, sum(n)::bigint from j where title is not null group by 2""",
    "agg27_recount": f"""with {OBS}, k as (select ip, country, row_number() over (partition by ip order by count(*) desc, country) as rn from obs where country is not null group by 1, 2)
  select country, count(*) as n_ips from k where rn = 1 group by 1""",
    "set04_done": f"with {BRIDGE} select hash from bridge where seeders >= 200 union select lower(hash) from peers where last_seen = {_D}",
    "er04_canon_v2": f"with {_META} select old, new from canon",
    "er05_merged": f"""with {OBS}, {BRIDGE}, {_META}, b as (select hash, coalesce(new, ip_id) as ip_id from bridge left join canon on old = ip_id where ip_id is not null)
  select ip_id, country, count(distinct ip) as n_ips from obs join b using (hash) group by 1, 2""",
    "er06_name_guard": f"""with {BRIDGE}, c as (select {_SQUASH.format(c="ip")} as key, min(try_cast(release_date[1:4] as int)) as year from catalog_info where ip is not null group by 1),
  x as (select hash, category, c.year, list_filter({_WORDS.format(c=_PLAIN.format(c="title"))}, lambda x: x not in ({_IN(text.STOP_WORDS)})) as w, {_WORDS.format(c=_PLAIN.format(c="raw_name"))} as r,
    list_filter({_WORDS.format(c=_PLAIN.format(c=_CLEAN))}, lambda x: x not in ({_IN(text.STOP_WORDS)})) as k, nullif(regexp_extract(raw_name, '^.+?[^0-9]((?:19|20)[0-9]{{2}})(?:[^0-9]|$)', 1), '')::int as named
    from bridge left join c on c.key = {_SQUASH.format(c="title")} where raw_name is not null and title is not null),
  y as (select *, len(w) as n, len(list_intersect(w, r)) as met from x)
  select hash, year, coalesce(case when n = 0 then false when category = 'Movies' and coalesce(abs(named - year) > 1, false) then false when category = 'Movies' and n <= 2 then len(k) = n and len(list_intersect(k, w)) = n
    when n <= 3 then met = n when n = 4 then met >= 3 else met / n >= 0.6 end, false) as passes from y""",
    "er11_wrong": f"""with {BRIDGE}, g as (select ip_id, avg((len(list_intersect({_WORDS.format(c="raw_name")}, {_WORDS.format(c="title")})) * 2 >= len({_WORDS.format(c="title")}))::int::double) as agreement, count(*) as n
  from bridge where ip_id is not null and raw_name is not null and title is not null group by 1) select * from g where n >= 3 and agreement < 0.95""",
    "dq04_repeated": f"""with {BRIDGE}, r as (select *, row_number() over (partition by ip_id order by seeders desc nulls last, hash) as rn from bridge where ip_id is not null and raw_name is not null)
  select ip_id, count(*) as n, count(distinct lower(raw_name)) as names, count(distinct lower(raw_name)) <= 2 as hint from r where rn <= 12 group by 1 having count(*) >= 4""",
}
