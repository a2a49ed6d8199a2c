"""Normal forms of identifiers, as pure Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers in peers.ip that are no observers.
SENTINEL_PREFIXES = ("_queried_", "_marker_")
#: Spellings of an unknown or pooled country, after trimming and upper-casing.
UNKNOWN_COUNTRIES = ("", "XX", "??", "OTHER")
#: White space trimmed around identifiers; the same set in Spark and in the SQL oracles.
BLANKS = " \t\n\r"


def norm_id(c: Column | str) -> Column:
    """Without white space around it and in lower case."""
    return F.lower(F.btrim(c if isinstance(c, Column) else F.col(c), F.lit(BLANKS)))


def norm_country(c: Column | str) -> Column:
    """Upper-case code without white space; null where unknown or pooled. NA is a country."""
    up = F.upper(F.btrim(c if isinstance(c, Column) else F.col(c), F.lit(BLANKS)))
    return F.when(~up.isin(*UNKNOWN_COUNTRIES), up)


def is_observer(ip: Column | str) -> Column:
    """True for a real observer, false for null and for the markers."""
    c = ip if isinstance(ip, Column) else F.col(ip)
    marker = c.startswith(SENTINEL_PREFIXES[0]) | c.startswith(SENTINEL_PREFIXES[1])
    return F.coalesce(~marker, F.lit(False))
