"""URL rules by host suffix and path prefix, looked up by hash.

A URL is expanded into the host suffixes of as many labels as some rule has times the path prefixes of a length that
some rule has, which are all that can meet a rule; their number depends on the rules, not on the URL. Expressions meet rules on the first digits of their SHA-256 digest, the whole digest confirms the meeting,
and the longest rule decides. Rules are broadcast while their text is at most `BROADCAST_BYTES`; beyond that the join
shuffles, and a hot expression is split by the adaptive skew join.

Defined results: a null URL or one without "://" has an empty host and path and gets the default verdict; rows
that repeat are judged each; an empty table gives an empty result; other columns are kept out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.common import lower_ascii

# The production rules.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
DEFAULT_VERDICT = "allow"
PREFIX_DIGITS = 8
BROADCAST_BYTES = 16 * 1024 * 1024


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def expressions(host: Column, path: Column, label_counts: Column, lengths: Column) -> Column:
    """Array of (host suffix, path prefix) that a rule for this URL can have."""
    n_labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = F.transform(
        F.filter(label_counts, lambda n: n <= n_labels), lambda n: F.call_function("substring_index", host, F.lit("."), -n)
    )
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(
        F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("h"), p.alias("p"))))
    )


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of `pages` (page_id, url)."""
    digest = _digest(F.col("rule_host"), F.col("rule_path"))
    known = rules.select(
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_length"),
        "rule_verdict",
        digest.alias("rule_digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
    )
    size = F.sum(F.octet_length("rule_host") + F.octet_length("rule_path") + 256)
    if (rules.agg(size).first()[0] or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    n_labels = F.size(F.split("rule_host", r"\."))
    counts, lengths = (
        rules.agg(F.array_sort(F.collect_set(n)).alias("n")).scalar() for n in (n_labels, F.length("rule_path"))
    )
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    parts = parts.withColumns({"row": F.monotonically_increasing_id(), "counts": counts, "lengths": lengths})
    of_url = expressions(*map(F.col, ("host", "path", "counts", "lengths")))
    looked_up = (
        parts.withColumn("e", F.explode_outer(of_url))
        .withColumn("digest", _digest(F.col("e.h"), F.col("e.p")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
        .join(known, "prefix", "left")
    )
    found = F.when(
        F.col("digest") == F.col("rule_digest"),
        F.struct(F.length("rule").alias("length"), "host_length", "rule", "rule_verdict"),
    )
    best = looked_up.groupBy("row", "page_id", "host", "path").agg(F.max(found).alias("best"))
    verdict = F.coalesce(F.col("best.rule_verdict"), F.lit(default))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
