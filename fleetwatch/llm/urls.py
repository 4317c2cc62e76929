"""URL rules: expressions of host suffixes and path prefixes met by equal short hashes, then by full digests."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8  # hexadecimal digits of the short hash


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all its parents, by whole labels."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) for every row.

    ``rules`` has host, path and verdict. Of the rules that fit, the longest (host and path together) wins, then the longer
    host, then block before allow; without one the verdict is ``default``. Null or unparsable urls have empty host and path
    and meet no rule, nor do rules with an empty host. Prefixes are tried in the lengths that rule paths have, which are
    the only numbers that reach the driver; a rule path longer than the url's never fits. Rules with null host or path
    never fit. Rows that repeat come back as often.
    """
    clean = rules.where("host <> '' AND path IS NOT NULL").select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict")
    ).distinct()
    lengths = sorted(r["n"] for r in clean.select(F.length("_path").alias("n")).distinct().collect())
    digest = F.sha2(F.concat(F.col("_host"), F.lit("\n"), F.col("_path")), 256)
    listed = clean.withColumn("_digest", digest).withColumn("_short", F.substring("_digest", 1, PREFIX))
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")).select(
        "_key", "_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path")
    )
    # The first expression is empty: it meets no rule, keeps the row and counts it.
    prefixes = F.array(*[F.struct(F.lit(n).alias("n")) for n in lengths]) if lengths else F.array().cast("array<struct<n:int>>")
    made = F.flatten(
        F.transform(
            suffixes(F.col("host")),
            lambda h: F.transform(
                F.filter(prefixes, lambda x: x["n"] <= F.length("path")),
                lambda x: F.concat(h, F.lit("\n"), F.substring(F.col("path"), F.lit(1), x["n"])),
            ),
        )
    )
    tried = rows.withColumn("_expr", F.explode(F.concat(F.array(F.lit("")), made)))
    tried = tried.withColumn("_full", F.when(F.col("_expr") != "", F.sha2("_expr", 256)))
    tried = tried.withColumn("_key8", F.substring("_full", 1, PREFIX))
    met = tried.join(listed, (F.col("_key8") == F.col("_short")) & (F.col("_full") == F.col("_digest")), "left")
    order = F.struct(
        F.length("_host") + F.length("_path"), F.length("_host"), (F.col("_verdict") == "block").cast("int"),
        F.concat("_host", "_path").alias("rule"), F.col("_verdict").alias("verdict"),
    )
    best = met.groupBy("_key", "_url", "host", "path").agg(
        F.max(F.when(F.col("_digest").isNotNull(), order)).alias("best"),
        F.count(F.when(F.col("_expr") == "", 1)).alias("rows"),
    )
    return best.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).select(
        F.col("_key").alias(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
