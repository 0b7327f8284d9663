"""URL filters: host-suffix and path-prefix expressions, matched by short hash prefixes.

Every distinct URL is expanded into expressions host-suffix + path-prefix (a
path prefix ends with a slash or is the whole path up to a rule's last
slash). Expressions meet the rules in an equi-join on the first
``prefix_digits`` hex digits of their SHA-256 digests, salted so that one
host suffix shared by a third of all URLs is spread. A hit counts only when
the full digests agree and the URL's path starts with the rule's whole path.
Of the rules that fit, the longest (host and path together, then host)
decides; between equal rules block wins.

Only suffixes and prefixes as long as the longest rule's are expanded:
longer ones cannot match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.frames import free_names

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlFilter:
    prefix_digits: int = 8
    salts: int = 8
    #: The verdict for URLs that no rule fits.
    otherwise: str = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, number sign or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to a question mark, number sign or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    """The expression of a rule or URL part: host, and path up to its last slash."""
    return F.concat(host, F.lit("\n"), path)


def _to_last_slash(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def matched(urls: DataFrame, rules: DataFrame, p: UrlFilter = UrlFilter()) -> DataFrame:
    """(host, path, rule, verdict) of each distinct (host, path) of ``urls`` that a rule fits.

    ``rules``: rule_host, rule_path, rule_verdict ('allow' or 'block').
    """
    r = rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL").distinct()
    r = r.withColumn("rule_key", _key(F.col("rule_host"), _to_last_slash(F.col("rule_path"))))
    longest = r.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.max(F.size(F.split("rule_path", "/"))).alias("slashes"),
    ).first()  # the rules' own bounds
    labels, slashes = longest["labels"] or 0, longest["slashes"] or 0
    r = r.withColumn("rule_digest", F.sha2("rule_key", 256)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1))))
    r = r.withColumn("short", F.substring("rule_digest", 1, p.prefix_digits))

    u = urls.select("host", "path").distinct()
    # the last n labels of the host, n up to the longest rule's
    suffixes = F.expr(f"transform(sequence(1, {max(labels, 1)}), n -> substring_index(host, '.', -n))")
    # the path up to its n-th slash (substring_index drops the slash, and gives the whole path beyond the last)
    prefixes = F.expr(f"transform(sequence(1, {max(slashes, 1)}), n -> substring_index(path, '/', n) || '/')")
    prefixes = F.filter(prefixes, lambda x: F.col("path").startswith(x))
    e = u.withColumn("suffix", F.explode(F.array_distinct(suffixes)))
    e = e.withColumn("prefix", F.explode(F.array_union(F.array(F.lit("")), prefixes)))
    e = e.withColumn("digest", F.sha2(_key(F.col("suffix"), F.col("prefix")), 256))
    e = e.withColumn("short", F.substring("digest", 1, p.prefix_digits)).withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(p.salts)).cast("int"))
    hit = e.join(r, ["short", "salt"]).where((F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"), (F.col("rule_verdict") == "block").alias("b"), rule.alias("rule"), F.col("rule_verdict").alias("verdict"))
    best = hit.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, p: UrlFilter = UrlFilter()) -> DataFrame:
    """``pages`` (url and any columns) with host, path, rule (null if none fits) and verdict.

    A url that is null or has no ``://`` has an empty host and path and fits
    no rule. Columns of these names in the input are replaced; repeated rows
    are judged alike; an empty rule table lets every url pass.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    parts = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    host, path = free_names(parts, "m_host", "m_path")
    found = matched(parts, rules, p).withColumnRenamed("host", host).withColumnRenamed("path", path)
    out = parts.join(found, (F.col("host") == F.col(host)) & (F.col("path") == F.col(path)), "left")
    return out.select(*pages.columns, "host", "path", "rule", F.coalesce("verdict", F.lit(p.otherwise)).alias("verdict"))
