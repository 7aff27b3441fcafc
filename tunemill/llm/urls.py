"""URL rules by hashed host-suffix and path-prefix expressions (native Spark functions only).

A URL becomes one expression for each of its host suffixes and path prefixes; expressions meet the rules on the first
32 bits of their SHA-256 and are confirmed by the whole digest. Only suffixes and prefixes of lengths that some rule has
are built, so the expansion is as small as the rules allow and still complete.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule; rules with a null part are
ignored; repeated pages stay separate rows; rules of equal length yield to the longer host, then to ``block``. Further
columns of the pages are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(" "), path), 256)


def hashed_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with digest, short prefix and rank in the order of precedence."""
    return (rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
            .select(F.concat("host", "path").alias("rule"), "verdict", _digest(F.col("host"), F.col("path")).alias("rule_digest"),
                    F.length("host").alias("host_length"))
            .withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_DIGITS)))


def _shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Label counts of the rules' hosts and lengths of their paths: at most as many numbers as the longest rule has characters."""
    row = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))), F.sort_array(F.collect_set(F.length("path")))).first()
    return row[0], row[1]


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict): one row per page with the longest rule that fits, else ``default``."""
    labels, lengths = _shapes(rules)
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.filter(F.array(*map(F.lit, labels)).cast("array<int>"), lambda n: n <= F.size(parts)),
                           lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: _digest(h, p))))
    rows = pages.select(F.col(key).alias("page_key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
                        F.monotonically_increasing_id().alias("row"))
    hashed = rows.select("*", F.explode_outer(expressions).alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS))
    known = hashed_rules(rules)
    found = hashed.join(known, (F.col("prefix") == F.col("rule_prefix")) & (F.col("digest") == F.col("rule_digest")), "left")
    rank = F.when(F.col("rule").isNotNull(), F.struct(
        F.length("rule").alias("n"), "host_length", (F.col("verdict") == "block").alias("block"), "rule", "verdict"))
    return (found.groupBy("row", "page_key", "host", "path").agg(F.max(rank).alias("best"))
            .select(F.col("page_key").alias(key), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
