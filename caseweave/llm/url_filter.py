"""URL rules by hashed host-suffix and path-prefix expressions.

Each URL is expanded into the (host suffix, path prefix) expressions that a rule
could have; their SHA-256 prefixes of four bytes are joined to those of the rules,
and a hit counts only if the full digests agree.  The longest rule wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.sources.tables import estimated_bytes

SMALL_RULES = 8 << 20
DEFAULT_VERDICT = "allow"
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty if it is null or has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as (verdict, host, path) rows; large lists can be read from a table instead."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    A rule with a null or empty host fits nothing; a null rule path is empty.  Of
    rules that fit, the longest host and path together wins, then the longer
    host, then block over allow.  A page that no rule fits has a null rule and
    the ``default`` verdict; so has a null URL.  Pages are told apart by row, so
    repeated and null ids are fine.  Expressions are only made of host depths
    and path lengths that some rule has, which is every one that can match.
    """
    rules = (
        rules.select("verdict", F.col("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"))
        .where(F.length("r_host") > 0)
        .groupBy("r_host", "r_path")
        .agg(F.max("verdict").alias("r_verdict"))  # 'block' > 'allow'
        .withColumn("digest", F.sha2(F.concat("r_host", F.lit("\0"), "r_path"), 256))
    )
    shapes = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("r_host", r"\.")))).alias("depths"),
        F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths"),
    ).first()  # host depths are at most 127, path lengths at most the longest URL
    host, path = host_and_path(F.col(url_col))
    judged = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*map(F.lit, shapes.depths)).cast("array<int>"), lambda d: d <= F.size(labels)),
        lambda d: F.array_join(F.slice(labels, F.size(labels) - d + 1, d), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, shapes.lengths)).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    digests = F.flatten(
        F.transform(
            suffixes, lambda h: F.transform(prefixes, lambda p: F.sha2(F.concat(h, F.lit("\0"), p), 256))
        )
    )
    table = rules.select(
        F.substring("digest", 1, 8).alias("short"),
        "digest",
        F.struct(
            (F.length("r_host") + F.length("r_path")).alias("size"),
            F.length("r_host").alias("host_size"),
            "r_verdict",
            F.concat("r_host", "r_path").alias("rule"),
        ).alias("hit"),
    )
    if estimated_bytes(table) < SMALL_RULES or len(shapes.depths) == 0 or table.count() < 10_000:
        table = F.broadcast(table)
    keyed = judged.withColumn("row", F.monotonically_increasing_id())
    hits = (
        keyed.select("row", F.explode_outer(digests).alias("want"), "id", "host", "path")
        .withColumn("short", F.substring("want", 1, 8))
        .join(table, "short", "left")
        .withColumn("hit", F.when(F.col("want") == F.col("digest"), F.col("hit")))
    )
    best = hits.groupBy("row", "id", "host", "path").agg(F.max("hit").alias("hit"))
    return best.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.r_verdict", F.lit(default)).alias("verdict"),
    )
