"""URL filters: pattern rules that only run on the URLs their rarest literal token fetches.

A rule is a regular expression over host and path, with the literal tokens that every text it fits must hold.
The frequency of these tokens over all URLs picks one token per rule; URLs are cut into tokens and joined with
that index, and only the fetched rules run. Everything is built-in Spark expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm.common import lower_ascii

RULES_SCHEMA = "rule string, verdict string, pattern string, base boolean, literals array<string>"


@dataclass(frozen=True)
class Rule:
    """A pattern with its verdict. Base rules outrank the others and are named in the result."""

    rule: str
    verdict: str
    pattern: str
    literals: list[str] = field(default_factory=list)
    base: bool = False


def site_rule(verdict: str, site: str) -> Rule:
    """A rule for a host, its subdomains and the paths that begin with the rule's path."""
    host, slash, path = site.partition("/")
    whole = re.findall("[a-z0-9]+", host) + re.findall("(?<=/)[a-z0-9]+(?=/)", slash + path)
    return Rule(site, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", whole, True)


#: The base rules.
BASE_RULES = [
    site_rule("block", "net/"), site_rule("allow", "example.net/en/"),
    site_rule("block", "example.com/de/"), site_rule("allow", "org/fr/"),
]
#: Rules for hosts and paths that name what is sold or farmed there.
PATTERN_RULES = [
    Rule("pills", "block", r"^[^/]*\bcheap-pills\b", ["cheap", "pills"]),
    Rule("farm", "block", r"^[^/]*\bspam-farm\b", ["spam", "farm"]),
    Rule("casino", "block", r"^[^/]*\bcasino\b", ["casino"]),
    Rule("adult", "block", r"^[^/]*\bxxx\b", ["xxx"]),
    Rule("warez", "block", "/warez/", ["warez"]),
    Rule("keygen", "block", "/keygen/", ["keygen"]),
]


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.rule, r.verdict, r.pattern, r.base, sorted(set(r.literals))) for r in rules]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return lower_ascii(F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(target: Column) -> Column:
    """Distinct runs of letters and digits, and the empty token, by which rules without literals are fetched."""
    return F.array_distinct(F.concat(F.split(lower_ascii(target), "[^a-z0-9]+"), F.array(F.lit(""))))


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule under the one of its literals that the fewest URLs hold; ``tokens`` has a row per URL and token."""
    literal = rules.select("rule", F.explode(F.when(F.size("literals") > 0, F.col("literals")).otherwise(F.array(F.lit("")))).alias("token"))
    counts = tokens.join(literal.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    ranked = literal.join(counts, "token", "left").groupBy("rule").agg(
        F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), F.col("token"))).alias("token")
    )
    return ranked.join(rules.drop("literals"), "rule")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    The longest base rule that fits decides; without one, the longest-named other pattern that fits
    (ties to the greater name); without any, ``default``. A null URL or one without ``://`` has an empty host and path and fits no
    base rule. The verdict belongs to the URL, so equal URLs are judged once and repeated rows all return; a page
    id may be null. Rule names must be unique. Other columns are ignored; no pages give no rows.
    """
    urls = pages.select("url").where(F.col("url").isNotNull()).distinct()
    targets = urls.select("url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("target"))
    tokens = targets.select("url", "target", F.explode(tokens_of(F.col("target"))).alias("token"))
    index = index_rules(rules, tokens.select("token"))
    fits = tokens.join(index, "token").where(F.expr("target rlike pattern"))
    size = F.length("rule").alias("size")
    best = fits.groupBy("url").agg(
        F.max_by(F.struct("rule", "verdict"), F.when(F.col("base"), F.struct(size, "rule"))).alias("named"),
        F.max_by("verdict", F.when(~F.col("base"), F.struct(size, F.col("rule")))).alias("other"),
    )
    joined = pages.select("page_id", "url").join(best, "url", "left")
    return joined.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("named.rule").alias("rule"),
        F.coalesce("named.verdict", "other", F.lit(default)).alias("verdict"),
    )
