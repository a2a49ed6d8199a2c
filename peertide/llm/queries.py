"""Queries p1_ and p5_ to p10_ and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peertide.functions.ids import is_observer, norm_country, norm_id
from peertide.llm.kmv import estimates, kmv, merge, set_operations
from peertide.llm.leak import leaks
from peertide.llm.overlap import overlaps
from peertide.llm.pii import find_personal, redact
from peertide.llm.resolve import match
from peertide.llm.tokens import encode_texts
from peertide.llm.topn import best_row, top_n
from peertide.session import durable, table

#: Values kept per sketch: a relative standard error of 3.1 %.
K = 1024


def _peer_sketches(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "peers").select("ip", "country", "last_seen").where(is_observer("ip"))
    p = p.select(F.col("last_seen").alias("obs_date"), norm_country("country").alias("country"), "ip")
    return durable(kmv(p, ["obs_date", "country"], F.col("ip"), K))


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """Hashes and catalogue entries of the same work, with a confidence."""
    h = table(spark, d, "hashes").select("hash", "raw_name", "title", "imdb_id", "category")
    return match(h, table(spark, d, "catalog_info"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).select("hash", "catalog_ip_id")


def _best_counts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "title_country").select("date", "country", "ip_id", "ip_count")
    keys = {"obs_date": F.col("date"), "country": norm_country("country"), "ip_id": norm_id("ip_id")}
    return best_row(t, keys, "ip_count")


def p5_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct observers per day, per country and per both, with bounds, beside the sums over titles."""
    base = _peer_sketches(spark, d)
    sums = _best_counts(spark, d)
    parts = []
    for level, group in (("day_country", ["obs_date", "country"]), ("day", ["obs_date"]), ("country", ["country"])):
        known = base
        for g in group:
            known = known.where(F.col(g).isNotNull())
        sk = known if len(group) == 2 else merge(known, group, K)
        s = sums.groupBy(*group).agg(F.sum("ip_count").alias("summed"))
        e = estimates(sk, group, K).join(s, group, "left")
        cols = [
            F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date") if "obs_date" in group else F.lit(None).cast("string").alias("obs_date"),
            F.col("country") if "country" in group else F.lit(None).cast("string").alias("country"),
        ]
        parts.append(e.select(F.lit(level).alias("level"), *cols, "kept", "estimate", "lower", "upper", "summed"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p5_day_to_day(spark: SparkSession, d: str) -> DataFrame:
    """Of each country and day: observers seen on the day before too, new and gone ones, from the sketches alone."""
    base = _peer_sketches(spark, d).where("obs_date is not null and country is not null")
    before = base.select(F.date_add("obs_date", 1).alias("obs_date"), "country", "h")
    return set_operations(base, before, ["obs_date", "country"], K)


def p6_top(spark: SparkSession, d: str) -> DataFrame:
    """The five best titles of each date and country, with rank and count."""
    out = top_n(durable(_best_counts(spark, d)), ["obs_date", "country"], "ip_count", ["ip_id"], 5)
    return out.select(F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"), "country", "ip_id", "ip_count", "rank")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_top(spark, d).select("obs_date", "country", "ip_id")


def p6_hot(spark: SparkSession, d: str) -> DataFrame:
    """The same over groups nearly all of which are hot: every one of more than eight rows is split."""
    out = top_n(durable(_best_counts(spark, d)), ["obs_date", "country"], "ip_count", ["ip_id"], 5, heavy_rows=8)
    return out.select(F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"), "country", "ip_id", "ip_count", "rank")


def p7_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of hashes that share at least half of the smaller one's observers, with sizes."""
    p = table(spark, d, "peers").select("hash", "ip").where(is_observer("ip"))
    out = overlaps(p, F.lower("hash"), F.col("ip"))
    return out.select(F.col("set_a").alias("hash_a"), F.col("set_b").alias("hash_b"), "n_a", "n_b", "n_shared")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_overlap(spark, d).select("hash_a", "hash_b")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every document as ids of byte_bpe_50k."""
    return encode_texts(table(spark, d, "documents"))


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a window of 12 words within one word edit of a window of an item."""
    return leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Of those the ones with at least 12 successive words of the item."""
    return p9_leaks(spark, d).where("longest_run >= 12").select("doc_id", "item_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of personal information, once per document, kind and value."""
    return find_personal(table(spark, d, "documents")).select("doc_id", "kind", "value").distinct()


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every document with placeholders in place of personal information."""
    docs = table(spark, d, "documents")
    return redact(docs, find_personal(docs))


QUERIES = {f.__name__: f for f in (p1_matches, p1_found, p5_distinct, p5_day_to_day, p6_top, p6_found, p6_hot, p7_overlap, p7_found, p8_ids, p9_leaks, p9_found, p10_found, p10_redacted)}

_OBSERVER = "not (starts_with(ip, '_queried_') or starts_with(ip, '_marker_'))"
_UP = "upper(trim(country, E' \\t\\n\\r'))"
_COUNTRY = f"case when {_UP} not in ('', 'XX', '??', 'OTHER') then {_UP} end"
_BEST = f"""select date as obs_date, {_COUNTRY} as country, lower(trim(ip_id, E' \\t\\n\\r')) as ip_id, max(ip_count) as ip_count
  from title_country where ip_count is not null and ip_id is not null and date is not null and {_COUNTRY} is not null group by 1, 2, 3"""
_TOP = f"""with b as ({_BEST}), r as (select *, row_number() over (partition by obs_date, country order by ip_count desc, ip_id) as rank from b)
"""
_PAIRS = f"""with e as (select distinct lower(hash) as h, ip from peers where {_OBSERVER}),
s as (select h, count(*) as n from e group by 1 having count(*) >= 40), b as (select e.h, e.ip, s.n from e join s using (h)),
c as (select x.h as hash_a, y.h as hash_b, x.n as n_a, y.n as n_b, count(*) as n_shared from b x join b y on x.ip = y.ip and x.h < y.h group by 1, 2, 3, 4),
f as (select * from c where 2 * n_shared >= least(n_a, n_b))
"""
_LEVEL = """select '{level}' as level, {day} as obs_date, {country} as country, kept, {est} as estimate, {est} * (1 - {err}) as lower,
  {est} * (1 + {err}) as upper, summed from (select {group}, count(*) as kept, max(h) as top from
  (select distinct {group}, h, dense_rank() over (partition by {group} order by h) as r from p where {known}) where r <= 1024 group by {group})
  left join (select {group}, sum(ip_count)::bigint as summed from b group by {group}) using ({group})"""
_EST = "case when kept >= 1024 then 1023.0::double / ((top + 1) / 1152921504606846976.0::double) else kept::double end"
_ERR = "case when kept >= 1024 then 1.959964::double / sqrt(1022.0::double) else 0.0::double end"


def _level(level: str, group: str, day: str, country: str) -> str:
    known = " and ".join(f"{g} is not null" for g in group.split(", "))
    return _LEVEL.format(level=level, group=group, day=day, country=country, known=known, est=f"({_EST})", err=f"({_ERR})")


_Z = "1.959964::double"


def _part(name: str, x: str) -> str:
    p, zz = f"({x}::double / n)", f"({_Z} * {_Z})"
    mid = f"(({p} + {zz} / (2 * n::double)) / (1 + {zz} / n::double))"
    half = f"({_Z} * sqrt({p} * (1 - {p}) / n::double + {zz} / (4 * n::double * n::double)) / (1 + {zz} / n::double))"
    wilson = [f"(case when top is null then {p} else {mid} {sign} {half} end)" for sign in "-+"]
    return f"u * {x} / n as {name}_est, u * (1 - rel) * {wilson[0]} as {name}_lower, u * (1 + rel) * {wilson[1]} as {name}_upper"


_DAY_TO_DAY = f"""with p as (select last_seen as obs_date, {_COUNTRY} as country, ('0x' || substr(md5(ip), 1, 15))::bigint as h from peers where {_OBSERVER}),
base as (select distinct obs_date, country, h from (select *, dense_rank() over (partition by obs_date, country order by h) as r from p) where r <= 1024 and obs_date is not null and country is not null),
two as (select obs_date, country, h, 1 as a, 0 as b from base union all select obs_date + 1, country, h, 0, 1 from base),
th as (select obs_date, country, least(case when sum(a) >= 1024 then max(case when a = 1 then h end) end, case when sum(b) >= 1024 then max(case when b = 1 then h end) end) as top from two group by 1, 2),
o as (select obs_date, country, h, max(a) as a, max(b) as b from two group by 1, 2, 3),
s as (select obs_date, country, count(*) as n, sum(a * b) as nb, sum(a * (1 - b)) as nl, sum((1 - a) * b) as nr, max(top) as top from o join th using (obs_date, country) where top is null or h <= top group by 1, 2),
u as (select *, case when top is null then n::double else greatest(n - 1, 0) / ((top + 1) / 1152921504606846976.0::double) end as u,
  case when top is null then 0.0::double else {_Z} / sqrt(greatest(n - 2, 1)::double) end as rel from s)
select obs_date, country, n as sample, u as union_est, u * (1 - rel) as union_lower, u * (1 + rel) as union_upper, {_part("both", "nb")}, {_part("left", "nl")}, {_part("right", "nr")} from u"""
ORACLE = {
    "p5_day_to_day": _DAY_TO_DAY,
    "p5_distinct": f"""with b as ({_BEST}), p as (select last_seen as obs_date, {_COUNTRY} as country, ('0x' || substr(md5(ip), 1, 15))::bigint as h
  from peers where {_OBSERVER})
"""
    + _level("day_country", "obs_date, country", "strftime(obs_date, '%Y-%m-%d')", "country")
    + "\nunion all "
    + _level("day", "obs_date", "strftime(obs_date, '%Y-%m-%d')", "null")
    + "\nunion all "
    + _level("country", "country", "null", "country"),
    "p6_top": _TOP + "select strftime(obs_date, '%Y-%m-%d') as obs_date, country, ip_id, ip_count, rank from r where rank <= 5",
    "p6_hot": _TOP + "select strftime(obs_date, '%Y-%m-%d') as obs_date, country, ip_id, ip_count, rank from r where rank <= 5",
    "p6_found": _TOP + "select strftime(obs_date, '%Y-%m-%d') as obs_date, country, ip_id from r where rank <= 5",
    "p7_overlap": _PAIRS + "select * from f",
    "p7_found": _PAIRS + "select hash_a, hash_b from f",
}
