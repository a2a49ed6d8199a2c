"""Tolerant readers of feeds and observation logs."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructType

SCAN_LOG = "date date, run_time string, hash string, ip_id string, title string, category string, seeders int, country string, peer_count int, bep33_seeders int, bep33_leechers int"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on any file system Hadoop knows."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def scan_log(spark: SparkSession, folder: str, day: str, schema: str = SCAN_LOG) -> DataFrame:
    """A day's log of all workers (`<day>_w*.csv`), else the single file `<day>.csv`, else an error. Torn lines stay as rows
    with `_bad` set and all else null as far as it could not be read; columns an old file lacks are null."""
    for pattern in (f"{folder}/{day}_w*.csv", f"{folder}/{day}.csv"):
        if exists(spark, pattern):
            return tolerant_csv(spark, pattern, schema)
    raise FileNotFoundError(f"no log of {day} in {folder}")


def tolerant_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    s = StructType.fromDDL(f"{schema}, _bad string")
    r = spark.read.schema(s).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("enforceSchema", True)
    rows = r.option("columnPruning", False).csv(path)  # a line is only seen to be torn when all of it is parsed
    none = F.coalesce(F.substring(F.col(s.fieldNames()[0]).cast("string"), 1, 0), F.lit(""))  # Spark refuses to read the mark alone
    return rows.withColumn("_bad", F.concat("_bad", none)).withColumn("_file", F.input_file_name())


def torn(df: DataFrame, warn: float = 0.001) -> DataFrame:
    """Rows, torn lines and whether their share calls for a warning, per file."""
    g = df.groupBy(F.element_at(F.split("_file", "/"), -1).alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), F.count("_bad").alias("n_torn"))
    return g.withColumn("warn", F.col("n_torn") > F.col("n_rows") * warn)


def good(df: DataFrame) -> DataFrame:
    return df.where("_bad is null").drop("_bad", "_file")


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of the schema: cast where they exist (null where that fails), null where they do not, zero for missing
    integers."""
    have = {c.lower(): c for c in df.columns}
    out: list[Column] = []
    for f in schema.fields:
        c = F.col(have[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)
        if f.dataType.typeName() in ("integer", "long", "short"):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def dated_feeds(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All daily feeds of a folder with the date of their name; files without one are passed over."""
    df = tolerant_csv(spark, f"{folder}/*.csv", schema)
    day = F.regexp_extract("_file", r"/(\d{4})[-_]?(\d{2})[-_]?(\d{2})[^/]*\.csv$", 0)
    digits = F.regexp_replace(F.regexp_extract(day, r"/([\d_-]+)", 1), "[^0-9]", "")
    return df.withColumn("feed_date", F.to_date(F.nullif(F.substring(digits, 1, 8), F.lit("")), "yyyyMMdd")).where("feed_date is not null")


def optional(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame | None]:
    """Parquet sources by name; a missing one is None (see tagged_union)."""
    return {k: spark.read.parquet(p) if exists(spark, p) else None for k, p in paths.items()}


def compact_peers(payload: Column, size: int = 6) -> Column:
    """Addresses and ports of a compact peer list (6 bytes each for IPv4) as an array of structs."""
    n = F.floor(F.length(payload) / size).cast("int")
    number = lambda at, k: F.conv(F.hex(F.substr(payload, at, F.lit(k))), 16, 10).cast("bigint")

    def peer(i: Column) -> Column:
        at = i * size + 1
        ip = F.concat_ws(".", *[number(at + k, 1).cast("string") for k in range(4)])
        return F.struct(ip.alias("ip"), number(at + 4, 2).cast("int").alias("port"))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), peer)).otherwise(F.array().cast("array<struct<ip:string,port:int>>"))


def compact_peers_v6(payload: Column, size: int = 18) -> Column:
    """The same for IPv6: 16 bytes of address in groups of four hex digits, two of port."""
    n = F.floor(F.length(payload) / size).cast("int")

    def peer(i: Column) -> Column:
        at = i * size + 1
        groups = [F.lower(F.hex(F.substr(payload, at + 2 * k, F.lit(2)))) for k in range(8)]
        return F.struct(F.concat_ws(":", *groups).alias("ip"), F.conv(F.hex(F.substr(payload, at + 16, F.lit(2))), 16, 10).cast("int").alias("port"))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), peer)).otherwise(F.array().cast("array<struct<ip:string,port:int>>"))


def bencode(data: bytes) -> object:
    """A bencoded value: integers, byte strings, lists, dictionaries. Raises ValueError on anything else."""
    out, at = _benc(data, 0)
    if at != len(data):
        raise ValueError("bytes after the value")
    return out


def _benc(b: bytes, at: int) -> tuple[object, int]:
    head = b[at : at + 1]
    if head == b"i":
        end = b.index(b"e", at)
        return int(b[at + 1 : end]), end + 1
    if head in (b"l", b"d"):
        items, at = [], at + 1
        while b[at : at + 1] != b"e":
            if at >= len(b):
                raise ValueError("value without end")
            item, at = _benc(b, at)
            items.append(item)
        return (items if head == b"l" else dict(zip(items[::2], items[1::2], strict=True))), at + 1
    if head.isdigit():
        colon = b.index(b":", at)
        end = colon + 1 + int(b[at:colon])
        if end > len(b):
            raise ValueError("string without end")
        return b[colon + 1 : end], end
    raise ValueError("no value")


@pandas_udf(StringType())
def bencode_json(s: pd.Series) -> pd.Series:
    """Bencoded values as JSON, byte strings as text where they are UTF-8 and as hex where not; null where broken."""

    def plain(x: object) -> object:
        if isinstance(x, bytes):
            try:
                return x.decode()
            except UnicodeDecodeError:
                return x.hex()
        if isinstance(x, list):
            return [plain(y) for y in x]
        if isinstance(x, dict):
            return {str(plain(k)): plain(v) for k, v in x.items()}
        return x

    def one(x: bytes | None) -> str | None:
        try:
            return None if x is None else json.dumps(plain(bencode(x)), sort_keys=True)
        except ValueError:
            return None

    return s.map(one)


def magnet_hashes(html: Column) -> Column:
    """Content hashes of the magnet links of a page, distinct, in order and in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(r"(?i)urn:btih:([0-9a-f]{40})"), F.lit(1)), F.lower))


def last_mark(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The last line of a log that matches, with its first group; lines carry their offset, so no line is sorted for it."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at")).where(F.col("value").rlike(pattern))
    return lines.agg(F.max(F.struct("at", "value")).alias("m")).select(F.regexp_extract("m.value", pattern, 1).alias("mark"))


def previous_day(spark: SparkSession, folder: str, day: str, schema: str) -> DataFrame | None:
    """A day's table as Parquet, else as CSV, else None."""
    if exists(spark, f"{folder}/{day}.parquet"):
        return align(spark.read.parquet(f"{folder}/{day}.parquet"), StructType.fromDDL(schema))
    if exists(spark, f"{folder}/{day}.csv"):
        return good(tolerant_csv(spark, f"{folder}/{day}.csv", schema))
    return None


def json_rows(spark: SparkSession, path: str, schema: str, items: str) -> DataFrame:
    """Landed JSON answers, one row per element of their array `items`."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode(items).alias("_x")).select("_x.*")


def xml_rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Landed XML or RSS, one row per element `tag`."""
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
