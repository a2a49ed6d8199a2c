"""Queries src*, snk*: tables written in the forms that feeds and exports take, and read back by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peertide.functions.ids import norm_id
from peertide.plans.common import AS_OF, OBS, WEEKLY, observations, weekly
from peertide.session import scratch, table
from peertide.sources import feeds, sinks

_SCHEMA = "country string, ip_id string, ip_count long"


def _week(spark, d) -> DataFrame:
    return weekly(spark, d).where(F.col("date") == F.lit(AS_OF).cast("date")).select("country", "ip_id", "ip_count")


def src01_scan_log(spark, d):
    """A day's log of two workers as CSV, read by its pattern; torn lines would be counted and left out."""
    at = scratch(spark)
    w = _week(spark, d)
    for k in (0, 1):
        w.where(F.pmod(F.xxhash64("ip_id"), F.lit(2)) == k).write.option("header", True).csv(f"{at}/{AS_OF}_w{k}.csv")
    return feeds.good(feeds.scan_log(spark, at, AS_OF, _SCHEMA)).groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.sum("ip_count").alias("total"))


def src02_torn(spark, d):
    """Lines cut off in the middle are counted and the rest is kept: counts that end in 3 are written torn."""
    at = scratch(spark)
    w = _week(spark, d)
    torn = F.col("ip_count") % 10 == 3
    line = F.when(torn, F.concat_ws(",", "country", "ip_id")).otherwise(F.concat_ws(",", "country", "ip_id", F.col("ip_count").cast("string")))
    head = spark.range(1).select(F.lit("country,ip_id,ip_count").alias("value"))
    head.union(w.select(line.alias("value"))).coalesce(1).write.text(f"{at}/{AS_OF}.csv")
    return feeds.torn(feeds.scan_log(spark, at, AS_OF, _SCHEMA)).drop("file")


def src04_align(spark, d):
    """Any table under a fixed schema: cast, zero for missing counts, null for missing texts."""
    want = StructType.fromDDL("ip_id string, ip_count int, bep33_seeders int, note string")
    return feeds.align(table(spark, d, "title_country").where(F.col("date") == F.lit(AS_OF).cast("date")).withColumnRenamed("ip_count", "IP_COUNT"), want)


def src07_previous_day(spark, d):
    """The day before as Parquet, else as CSV: here it is a CSV."""
    at = scratch(spark)
    _week(spark, d).write.option("header", True).csv(f"{at}/{AS_OF}.csv")
    return feeds.previous_day(spark, at, AS_OF, _SCHEMA)


def src11_dated(spark, d):
    """Daily feeds with the date of their file name."""
    at = scratch(spark)
    days = [r.date for r in weekly(spark, d).select("date").distinct().collect()]  # one row per day of the week
    for day in days:
        weekly(spark, d).where(F.col("date") == F.lit(day)).select("country", "ip_id", "ip_count").coalesce(1).write.option("header", True).csv(f"{at}/feed-{day}.csv")
    rows = feeds.tolerant_csv(spark, f"{at}/feed-*.csv", _SCHEMA)
    day = F.to_date(F.regexp_extract("_file", r"feed-([0-9-]{10})[.]csv", 1))
    return feeds.good(rows.withColumn("feed_date", day)).groupBy("feed_date").agg(F.count(F.lit(1)).alias("n"))


def src13_json(spark, d):
    """Landed JSON answers: a row for each element of the array."""
    at = scratch(spark)
    c = table(spark, d, "catalog_info").select("ip_id", "ip")
    c.groupBy(F.split_part("ip_id", F.lit("-"), F.lit(1)).alias("kind")).agg(F.collect_list(F.struct("ip_id", "ip")).alias("items")).repartition("kind").write.json(f"{at}/answers")
    return spark.read.schema("items array<struct<ip_id:string,ip:string>>").json(f"{at}/answers").select(F.explode("items").alias("x")).select("x.*")


def src14_xml(spark, d):
    """Landed XML: a row for each element."""
    at = scratch(spark)
    table(spark, d, "catalog_info").select("ip_id", "imdb_id").where("imdb_id is not null").write.format("xml").option("rowTag", "item").option("rootTag", "rss").save(f"{at}/feed")
    return feeds.xml_rows(spark, f"{at}/feed", "item", "ip_id string, imdb_id string")


def src15_magnets(spark, d):
    """Content hashes of magnet links of pages (made of hashes), distinct and in order."""
    h = table(spark, d, "hashes").select("hash").distinct()
    page = F.concat(F.lit('<a href="magnet:?xt=urn:btih:'), F.upper("hash"), F.lit('&dn=x">x</a><a href="magnet:?xt=urn:btih:'), "hash", F.lit('">'))
    return h.select("hash", F.array_join(feeds.magnet_hashes(page), ",").alias("found"))


def src18_compact(spark, d):
    """Compact peer lists: six bytes an address and port, packed and unpacked again."""
    o = observations(spark, d).select(F.regexp_extract("ip", r"([0-9]+)$", 1).cast("bigint").alias("n")).where("n is not null").distinct()
    payload = F.unhex(F.concat(F.lpad(F.hex("n"), 8, "0"), F.lpad(F.hex(F.col("n") % 60000), 4, "0")))
    p = o.select("n", F.explode(feeds.compact_peers(payload)).alias("p"))
    return p.select("n", "p.ip", "p.port")


def snk01_ordered(spark, d):
    """A small ordered export as one CSV."""
    at = scratch(spark)
    top = _week(spark, d).orderBy(F.desc("ip_count"), "ip_id", "country").limit(50)
    sinks.ordered_csv(top, f"{at}/top", [F.desc("ip_count"), "ip_id", "country"], ["country", "ip_id", "ip_count"])
    return spark.read.schema(_SCHEMA).option("header", True).csv(f"{at}/top")


def snk05_replace_day(spark, d):
    """A table by day of which one day is written again with other rows: that day is replaced, the others stay."""
    at = scratch(spark)
    w = weekly(spark, d).select("date", "country", "ip_id", "ip_count")
    sinks.write_days(w, f"{at}/mart")
    sinks.write_days(w.where((F.col("date") == F.lit(AS_OF).cast("date")) & (F.col("ip_count") >= 100)), f"{at}/mart")
    return spark.read.parquet(f"{at}/mart").groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("ip_count").alias("total"))


def snk06_replace(spark, d):
    """Insert or replace by key: a later load's row stands for an earlier one of the same title and day."""
    t = table(spark, d, "title_demand").where("ip_id is not null and date is not null").select(norm_id("ip_id").alias("ip_id"), "date", "ip_count", "loaded_at")
    return t.groupBy("ip_id", "date").agg(F.max(F.struct("loaded_at", F.coalesce("ip_count", F.lit(-1)).alias("c"), "ip_count")).alias("m")).select("ip_id", "date", F.col("m.ip_count").alias("ip_count"))


def snk09_dated_path(spark, d):
    """Day tables under YYYY/MM/DD, read back by their path."""
    at = scratch(spark)
    for day in (AS_OF,):
        _week(spark, d).write.parquet(f"{at}/merged/{day.replace('-', '/')}")
    return spark.read.parquet(f"{at}/merged/*/*/*").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def snk13_backup(spark, d):
    """Rows as they were before a change, as JSON lines."""
    at = scratch(spark)
    sinks.backup_json(_week(spark, d), f"{at}/backup")
    return spark.read.schema(_SCHEMA).json(f"{at}/backup")


def snk14_stub(spark, d):
    """One marker per hash and country active in the last days."""
    return sinks.marker_stub(observations(spark, d).select("hash", "ip", "country", "last_seen"), AS_OF).where("last_seen is not null")


QUERIES = {k: f for k, f in globals().items() if k[:3] in ("src", "snk") and callable(f)}

_DAY = f"date = date '{AS_OF}'"
_STUB = f"with {OBS} select hash, '_marker_' || coalesce(country, 'XX') as ip, country, max(last_seen) as last_seen from obs where last_seen >= date '{AS_OF}' - 5 group by hash, country"
ORACLE = {
    "src01_scan_log": f"with {WEEKLY} select country, count(*) as n, sum(ip_count)::bigint as total from weekly where {_DAY} group by 1",
    "src02_torn": f"with {WEEKLY} select count(*) as n_rows, count(*) filter (ip_count % 10 = 3) as n_torn, count(*) filter (ip_count % 10 = 3) > 0.001 * count(*) as warn from weekly where {_DAY}",
    "src04_align": f"select ip_id, coalesce(ip_count, 0)::int as ip_count, 0 as bep33_seeders, null::varchar as note from title_country where {_DAY}",
    "src07_previous_day": f"with {WEEKLY} select country, ip_id, ip_count from weekly where {_DAY}",
    "src11_dated": f"with {WEEKLY} select date as feed_date, count(*) as n from weekly group by 1",
    "src13_json": "select ip_id, ip from catalog_info where ip_id is not null",
    "src14_xml": "select ip_id, imdb_id from catalog_info where imdb_id is not null",
    "src15_magnets": "select distinct hash, lower(hash) as found from hashes",
    "src18_compact": f"""with {OBS}, n as (select distinct try_cast(regexp_extract(ip, '([0-9]+)$', 1) as bigint) as n from obs) select n, (n // 16777216 % 256) || '.' || (n // 65536 % 256) || '.' || (n // 256 % 256) || '.' || (n % 256) as ip,
  (n % 60000)::int as port from n where n is not null""",
    "snk01_ordered": f"with {WEEKLY} select country, ip_id, ip_count from weekly where {_DAY} order by ip_count desc, ip_id, country limit 50",
    "snk05_replace_day": f"with {WEEKLY} select date, count(*) as n, sum(ip_count)::bigint as total from weekly where not {_DAY} or ip_count >= 100 group by 1",
    "snk06_replace": """select ip_id, date, ip_count from (select *, row_number() over (partition by ip_id, date order by loaded_at desc nulls last, coalesce(ip_count, -1) desc) as rn
  from (select lower(trim(ip_id, E' \\t\\n\\r')) as ip_id, date, ip_count, loaded_at from title_demand where ip_id is not null and date is not null)) where rn = 1""",
    "snk09_dated_path": f"with {WEEKLY} select country, count(*) as n from weekly where {_DAY} group by 1",
    "snk13_backup": f"with {WEEKLY} select country, ip_id, ip_count from weekly where {_DAY}",
    "snk14_stub": _STUB,
}
