"""Queries er*, fn*: canonical ids and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from peertide.functions import text
from peertide.operators import identity, similar
from peertide.plans.common import BRIDGE, bridge, weekly
from peertide.session import table


def _imdb(c):
    return F.nullif(F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"([0-9]{7,})", 1), F.lit(""))


def er01_resolve(spark, d):
    """Catalogue id of each hash by its imdb number; unmapped where there is none."""
    c = table(spark, d, "catalog_info").select("ip_id", _imdb(F.col("imdb_id")).alias("imdb")).where("imdb is not null")
    by = c.groupBy("imdb").agg(F.min("ip_id").alias("id"))
    known = table(spark, d, "catalog_info").select(F.col("ip_id").alias("id"))
    h = bridge(spark, d).select("hash", "ip_id", _imdb(F.col("imdb_id")).alias("imdb"))
    return identity.resolve(h, by, known).select("hash", "resolved", "unmapped")


def _titles(spark, d):
    b = bridge(spark, d).where("ip_id is not null")
    return b.groupBy("ip_id").agg(
        F.min(text.squash(F.col("title"))).alias("title"), F.min("category").alias("category"), F.max(_imdb(F.col("imdb_id"))).alias("imdb"), F.count(F.lit(1)).alias("n_hashes")
    )


def er02_canon_v1(spark, d):
    """Ids with one title and category: the one with an imdb number, then with most hashes, stands for all."""
    t = _titles(spark, d)
    order = [F.col("imdb").isNull(), -F.col("n_hashes")]
    return identity.canonical_map(t, [F.col("title"), F.col("category")], "ip_id", order)


def er03_apply_canon(spark, d):
    """Demand of the week under canonical ids."""
    m = er02_canon_v1(spark, d)
    w = weekly(spark, d).join(m, F.col("ip_id") == F.col("old"), "left").withColumn("ip_id", F.coalesce("new", "ip_id"))
    return w.groupBy("date", "country", "ip_id").agg(F.max("ip_count").alias("ip_count"))


def er07_fuzzy(spark, d):
    """Title spellings of one hash title against the catalogue by sequence similarity: every pair of ratio 0.82 or more."""
    a = bridge(spark, d).where("title is not null").select(text.squash(text.fold_accents("title")).alias("title")).distinct()
    b = table(spark, d, "catalog_info").where("ip is not null").select("ip_id", text.squash(text.fold_accents("ip")).alias("name"))
    pairs = similar.similar_pairs(a, b, "title", "ip_id", "name", least=0.82 - 1e-6)
    return pairs.withColumn("ratio", F.round("ratio", 6)).where("ratio >= 0.82").select("title", "ip_id", "ratio")


def er10_alias_best(spark, d):
    """The one catalogue entry whose words cover most of a title's, none where two are equally good."""
    a = bridge(spark, d).where("title is not null").select("title").distinct()
    w = a.select("title", F.explode(text.words(F.col("title"))).alias("w"))
    c = table(spark, d, "catalog_info").select("ip_id", F.explode(text.words(F.col("ip"))).alias("w"))
    n = w.join(c, "w").where(F.length("w") > 3).groupBy("title", "ip_id").agg(F.count(F.lit(1)).alias("score"))
    return identity.strict_best(n, ["title"], "score", "ip_id")


def er12_prefix(spark, d):
    """Catalogue entries whose key is the first two to five words of a release name; the longest wins."""
    names = bridge(spark, d).where("raw_name is not null").select("hash", text.word_list(F.col("raw_name")).alias("w"))
    parts = names.select("hash", F.explode(F.sequence(F.lit(2), F.lit(5))).alias("k"), "w").where("size(w) >= k")
    parts = parts.select("hash", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("key"))
    c = table(spark, d, "catalog_info").select("ip_id", F.array_join(text.word_list(F.col("ip")), " ").alias("key"))
    j = parts.join(c, "key").groupBy("hash").agg(F.min(F.struct((-F.col("k")).alias("m"), "ip_id")).alias("b"))
    return j.select("hash", F.col("b.ip_id").alias("ip_id"), (-F.col("b.m")).alias("n_words"))


def er15_site_match(spark, d):
    """Headings of pages in documents matched to titles by their key."""
    h = table(spark, d, "documents").where(F.col("text").contains("<h3>")).select("doc_id", F.explode(text.html_texts(F.col("text"), "h3")).alias("heading"))
    h = h.select("doc_id", text.title_key(F.col("heading")).alias("key")).where(F.length("key") >= 3)
    t = bridge(spark, d).where("ip_id is not null and title is not null").select(text.title_key(F.col("title")).alias("key"), "ip_id").groupBy("key").agg(F.min("ip_id").alias("ip_id"))
    return h.join(t, "key").select("doc_id", "ip_id").distinct()


def fn_s01_squash(spark, d):
    return table(spark, d, "hashes").where("title is not null").select(text.squash(F.col("title")).alias("title")).groupBy("title").agg(F.count(F.lit(1)).alias("n"))


def fn_s03_title_key(spark, d):
    return table(spark, d, "catalog_info").select("ip_id", text.title_key(F.col("ip")).alias("key"))


def fn_s09_year(spark, d):
    return table(spark, d, "hashes").where("raw_name is not null").select("raw_name", text.first_year(F.col("raw_name")).alias("year")).distinct()


def fn_s10_tokens(spark, d):
    return bridge(spark, d).where("raw_name is not null").select("hash", F.array_join(text.name_tokens(F.col("raw_name")), " ").alias("tokens"))


def fn_s17_sequel(spark, d):
    return table(spark, d, "catalog_info").select("ip_id", text.sequel(F.col("ip")).alias("number"))


def fn_s18_category(spark, d):
    return bridge(spark, d).where("raw_name is not null").groupBy(text.category_guess(F.col("raw_name")).alias("guess"), "category").agg(F.count(F.lit(1)).alias("n"))


def fn_s25_html(spark, d):
    """Headings and links of pages in documents."""
    p = table(spark, d, "documents").where(F.col("text").contains("<h3>"))
    return p.select("doc_id", F.array_join(text.html_texts(F.col("text"), "h3"), "|").alias("headings"), F.size(text.html_links(F.col("text"))).alias("n_links"))


def fn_s02_fold(spark, d):
    return table(spark, d, "catalog_info").select("ip_id", text.fold_accents("ip").alias("name"))


def fn_d01_processing_date(spark, d):
    return table(spark, d, "title_demand").groupBy(text.processing_date(F.col("loaded_at")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def fn_a05_map_topk(spark, d):
    """The six countries with most peers of each channel, as one ranked text; ties by country."""
    a = table(spark, d, "acestream_demand").where("peer_country is not null").groupBy("infohash", "peer_country").agg(F.sum("peer_count").alias("n"))
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("peer_country").alias("c")))), 1, 6)
    return a.groupBy("infohash").agg(F.array_join(F.transform(ranked, lambda x: F.concat(x["c"], F.lit(":"), (-x["m"]).cast("string"))), ",").alias("top"))


QUERIES = {k: f for k, f in globals().items() if k.startswith(("er0", "er1", "fn_")) and callable(f)}

_IMDB = "nullif(regexp_extract(lower(coalesce(imdb_id, '')), '([0-9]{7,})', 1), '')"
_SQUASH = r"trim(regexp_replace(lower({c}), '\s+', ' ', 'g'))"
_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> ''))"
_LIST = "list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> '')"
_KEY = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({c}), '&[a-z]+;|&#[0-9]+;', ' ', 'g'), '\b(19|20)[0-9]{{2}}\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), '\s+', ' ', 'g'))"
_TITLES = f"""titles as (select ip_id, min({_SQUASH.format(c="title")}) as title, min(category) as category, max({_IMDB}) as imdb, count(*) as n_hashes from bridge where ip_id is not null group by 1)"""
_V1 = """v1 as (select ip_id as old, first_value(ip_id) over (partition by title, category order by imdb is null, n_hashes desc, ip_id) as new from titles where title is not null and category is not null)"""
_TOKENS_DROP = ", ".join(f"'{w}'" for w in (*text.STOP_WORDS, *text.TECH_WORDS))
ORACLE = {
    "er01_resolve": f"""with {BRIDGE}, c as (select {_IMDB} as imdb, min(ip_id) as id from catalog_info group by 1)
  select hash, coalesce(c.id, k.ip_id) as resolved, (coalesce(c.id, k.ip_id) is null)::int as unmapped from (select hash, ip_id, {_IMDB} as imdb from bridge) b
  left join c on c.imdb = b.imdb left join (select distinct ip_id from catalog_info) k on k.ip_id = b.ip_id""",
    "er02_canon_v1": f"with {BRIDGE}, {_TITLES}, {_V1} select old, new from v1 where old <> new",
    "er03_apply_canon": f"""with {BRIDGE}, {_TITLES}, {_V1}, w as (select date, case when upper(trim(country, E' \\t\\n\\r')) not in ('', 'XX', '??', 'OTHER') then upper(trim(country, E' \\t\\n\\r')) end as country,
  lower(trim(ip_id, E' \\t\\n\\r')) as ip_id, ip_count from title_country where ip_id is not null and ip_count is not null)
  select date, country, coalesce(new, ip_id) as ip_id, max(ip_count) as ip_count from w left join v1 on old = ip_id where country is not null group by 1, 2, 3""",
    "er10_alias_best": f"""with {BRIDGE}, a as (select title, unnest({_WORDS.format(c="title")}) as w from (select distinct title from bridge where title is not null)),
  c as (select ip_id, unnest({_WORDS.format(c="ip")}) as w from catalog_info), n as (select title, ip_id, count(*) as score from a join c using (w) where length(w) > 3 group by 1, 2),
  r as (select *, rank() over (partition by title order by score desc) as k from n)
  select title, min(ip_id) as ip_id, max(score) as score from r where k = 1 group by 1 having count(distinct ip_id) = 1""",
    "er12_prefix": f"""with {BRIDGE}, n as (select hash, {_LIST.format(c="raw_name")} as w from bridge where raw_name is not null), p as (select hash, k, array_to_string(w[1:k], ' ') as key from n, range(2, 6) t(k) where len(w) >= k),
  c as (select ip_id, array_to_string({_LIST.format(c="ip")}, ' ') as key from catalog_info), j as (select hash, ip_id, k as n_words, row_number() over (partition by hash order by k desc, ip_id) as rn from p join c using (key))
  select hash, ip_id, n_words from j where rn = 1""",
    "er15_site_match": f"""with {BRIDGE}, h as (select doc_id, unnest(regexp_extract_all(text, '<h3[^>]*>([^<]*)</h3>', 1)) as heading from documents where contains(text, '<h3>')),
  k as (select doc_id, {_KEY.format(c="heading")} as key from h), t as (select {_KEY.format(c="title")} as key, min(ip_id) as ip_id from bridge where ip_id is not null and title is not null group by 1)
  select distinct doc_id, ip_id from k join t using (key) where length(key) >= 3""",
    "fn_s01_squash": f"select {_SQUASH.format(c='title')} as title, count(*) as n from hashes where title is not null group by 1",
    "fn_s03_title_key": f"select ip_id, {_KEY.format(c='ip')} as key from catalog_info",
    "fn_s09_year": "select distinct raw_name, nullif(regexp_extract(raw_name, '(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)', 1), '')::int as year from hashes where raw_name is not null",
    "fn_s10_tokens": f"""with {BRIDGE} select hash, array_to_string(list_sort(list_filter({_WORDS.format(c="raw_name")}, lambda x: x not in ({_TOKENS_DROP})
  and (not regexp_full_match(x, '[0-9]+') or coalesce(try_cast(x as int) between 2 and 99, false)))), ' ') as tokens from bridge where raw_name is not null""",
    "fn_s17_sequel": r"""with x as (select ip_id, regexp_extract(lower(ip), '\s([0-9]{1,2}|[ivx]+)\s*$', 1) as t from catalog_info) select ip_id, case when try_cast(t as int) between 2 and 20 then t::int
  when t in ('ii','iii','iv','v','vi','vii','viii','ix','x') then list_position(['ii','iii','iv','v','vi','vii','viii','ix','x'], t) + 1 else 1 end as number from x""",
    "fn_s18_category": f"""with {BRIDGE} select case when regexp_matches(lower(raw_name), '^\\[[^\\]]+\\].* - [0-9]{{1,3}}') then 'Anime' when regexp_matches(lower(raw_name), 's[0-9]{{2}}(e[0-9]{{2}})?|[0-9]x[0-9]{{2}}|season [0-9]') then 'Series'
  when regexp_matches(lower(raw_name), '(19|20)[0-9]{{2}}.*(480|720|1080|2160)p') then 'Movies' else 'Unknown' end as guess, category, count(*) as n from bridge where raw_name is not null group by 1, 2""",
    "fn_s25_html": """select doc_id, array_to_string(list_distinct(regexp_extract_all(text, '<h3[^>]*>([^<]*)</h3>', 1)), '|') as headings, len(list_distinct(regexp_extract_all(text, '<a href="([^"]+)"', 1))) as n_links
  from documents where contains(text, '<h3>')""",
    "fn_d01_processing_date": "select case when hour(loaded_at) < 6 then loaded_at::date - 1 else loaded_at::date end as day, count(*) as n from title_demand group by 1",
    "fn_a05_map_topk": """with a as (select infohash, peer_country as c, sum(peer_count)::bigint as n from acestream_demand where peer_country is not null group by 1, 2),
  r as (select *, row_number() over (partition by infohash order by n desc, c) as rn from a) select infohash, string_agg(c || ':' || n, ',' order by rn) as top from r where rn <= 6 group by 1""",
}
