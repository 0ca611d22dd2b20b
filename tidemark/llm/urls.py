"""URL allow and block rules as a sort-merge range join (operator 8, DataFrame functions only).

A rule is a host and a path prefix; it fits a url on that host or any of its
subdomains whose path starts with the prefix.  Hosts are turned round
(``com.example.www``), so that a rule is the interval of canonical keys that
begin with its own: zone (reversed host), then path.  Each url is placed once
in every zone that holds rules and contains its host.  Within a zone, urls and
the two ends of each rule are sorted by path bytes and swept: intervals of one
zone are nested or disjoint, so the active rules form a stack.  Its depth is a
running sum of begins minus ends, and its top is the last begun rule of that
depth.  The longest of a url's tops wins.

Zones with many urls are salted: their urls are spread over as many sweeps as
they have lots of ``per_sweep`` urls (four times the zone's rules at least, so
that the copies stay fewer than the urls), each with a copy of the zone's rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_or_plain, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def zone(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def match_rules(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", per_sweep: int = 5_000) -> DataFrame:
    """``id_col``, host, path, rule (host and path; null: none fits) and verdict of every url row.

    ``rules`` has host, path and verdict (allow or block).  Rows with a null
    host, path or verdict are left out; of equal rules with both verdicts the
    block holds.  The longest rule that fits wins (of equally long ones the
    one with the longer host); where none fits the verdict is ``default``.
    Null urls and urls without ``://`` have an empty host and path and fit no
    rule.  Repeated rows, and rows with a null id, stay as they are: rows are
    told apart by (id, host, path), and all rows of one triple have one
    verdict.  Other columns are not read.
    """
    pages = urls.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    rules = (rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna()
             .where(F.col("host") != "").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .select(zone(F.col("host")).alias("zone"), F.concat("host", "path").alias("rule"), "verdict",
                     F.length("host").alias("host_length"), F.col("path").cast("binary").alias("key")))

    # Each distinct (host, path) goes once into the zones of its host that hold rules.
    seen = pages.where(F.col("host") != "").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    turned = F.reverse(labels)
    placed = seen.select("host", "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(turned, 1, k), "."))).alias("zone"))
    zones = rules.groupBy("zone").agg((4 * F.count(F.lit(1))).alias("least"))
    lots = (placed.groupBy("zone").agg(F.count(F.lit(1)).alias("urls")).join(zones, "zone").select(
        "zone", F.ceil(F.col("urls") / F.greatest(F.lit(per_sweep), F.col("least"))).cast("int").alias("lots")))
    # One row per zone with rules and urls: counted, and broadcast if few, so that urls move only by (zone, lot).
    lots = small_or_plain(staged(lots, "url-lots"))
    placed = (placed.join(lots, "zone")
              .withColumn("lot", F.pmod(F.xxhash64("host", "path"), F.col("lots")).cast("int")).drop("lots"))
    copies = rules.join(lots, "zone").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))

    # Events by path bytes.  An interval ends before anything that begins with byte FF, which no text does.
    # At one key, begins come before urls (order 0, 1); of equal begins there is one per zone.
    top = F.struct("rule", "verdict", "host_length").alias("top")
    none = F.lit(None).cast("string")
    begins = copies.select("zone", "lot", "key", F.lit(0).alias("order"), F.lit(1).alias("step"), top,
                           none.alias("host"), none.alias("path"))
    ends = copies.select("zone", "lot", F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(0).alias("order"),
                         F.lit(-1).alias("step"), F.lit(None).cast(begins.schema["top"].dataType).alias("top"),
                         none.alias("host"), none.alias("path"))
    points = placed.select("zone", "lot", F.col("path").cast("binary").alias("key"), F.lit(1).alias("order"),
                           F.lit(0).alias("step"), F.lit(None).cast(begins.schema["top"].dataType).alias("top"),
                           "host", "path")
    sweep = Window.partitionBy("zone", "lot").orderBy("key", "order").rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("zone", "lot", "depth").orderBy("key", "order").rowsBetween(Window.unboundedPreceding, 0)
    swept = (begins.unionByName(ends).unionByName(points)
             .withColumn("depth", F.sum("step").over(sweep))
             .withColumn("top", F.last("top", ignorenulls=True).over(level))
             .where((F.col("order") == 1) & (F.col("depth") > 0)))
    best = swept.groupBy("host", "path").agg(
        F.max_by("top", F.struct(F.length("top.rule"), "top.host_length")).alias("top"))
    joined = pages.join(best, ["host", "path"], "left")
    return joined.select(F.col("id").alias(id_col), "host", "path", F.col("top.rule").alias("rule"),
                         F.coalesce("top.verdict", F.lit(default)).alias("verdict"))
