"""URL verdicts from pattern rules that are fetched by their rarest token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A regular expression over host, path and query; every url it fits holds each of `tokens` between other signs."""

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = False


def site_rule(action: str, rule: str) -> Rule:
    """`host/path`: the host and its subdomains, where the url's path begins with /path."""
    host, slash, path = rule.partition("/")
    # The last word of a path may go on in the url, so it is no token unless the rule ends it.
    tokens = re.findall(_TOKEN, host) + re.findall(_TOKEN + "(?=[^A-Za-z0-9])", path)
    return Rule(rule, action, r"^(?:[^/?#]*\.)?" + re.escape(host + slash + path), tuple(tokens), True)


SITES = (
    site_rule("block", "net/"),
    site_rule("allow", "example.net/en/"),
    site_rule("block", "example.com/de/"),
    site_rule("allow", "org/fr/"),
)

# Where no site rule fits: pages that hold no text worth reading.
PATTERNS = (
    Rule("session id in a query", "block", r"(?i)[?&;]phpsessid=", ("phpsessid",)),
    Rule("session id in a path", "block", r"(?i);jsessionid=", ("jsessionid",)),
    Rule("blog login", "block", r"/wp-login\.php(?:$|[?#])", ("wp", "login", "php")),
    Rule("shell script folder", "block", r"/cgi-bin/", ("cgi", "bin")),
    Rule("program file", "block", r"(?i)\.exe(?:$|[?#])", ("exe",)),
    Rule("package file", "block", r"(?i)\.apk(?:$|[?#])", ("apk",)),
    Rule("gambling host", "block", r"(?i)^[^/?#]*(?<![a-z0-9])casino(?![a-z0-9])", ("casino",)),
    Rule("adult host", "block", r"(?i)^[^/?#]*(?<![a-z0-9])porn(?![a-z0-9])", ("porn",)),
)


def _ascii_lower(column: Column) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and host with all that follows. Null, or no `://`: all empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = _ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.concat(host, F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)", 1))


def index(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per rule under the one of its tokens that the fewest urls hold. `urls` has `tokens`."""
    spark = urls.sparkSession
    rows = [(i, r.name, r.action, r.pattern, r.site, len(r.name), [t.lower() for t in r.tokens]) for i, r in enumerate(rules)]
    table = spark.createDataFrame(rows, "rule_id int, name string, action string, pattern string, site boolean, length int, tokens array<string>")
    words = table.select("rule_id", F.explode("tokens").alias("token"))
    held = urls.select(F.explode("tokens").alias("token")).join(words.select("token").distinct(), "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    rarest = Window.partitionBy("rule_id").orderBy(F.coalesce("urls", F.lit(0)), "token")
    chosen = words.join(held, "token", "left").withColumn("n", F.row_number().over(rarest)).filter("n = 1").select("rule_id", "token")
    return table.drop("tokens").join(chosen, "rule_id")


def verdicts(pages: DataFrame, sites: tuple[Rule, ...] = SITES, patterns: tuple[Rule, ...] = PATTERNS, default: str = "allow") -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict, pattern.

    The longest site rule that fits decides; else the longest pattern rule that fits; else `default`. `rule` names
    the site rule, `pattern` the pattern rule, each null where it did not decide. Distinct urls are judged, so a url
    with a third of all rows is judged once: the tokens of a url fetch the rules filed under them, and only these
    run their regular expressions. Rules without a token are refused.

    Null and empty urls and urls without `://` have an empty host and path and fit no rule. Repeated rows and null ids
    are judged row by row. Other columns are not read.
    """
    rules = (*sites, *patterns)
    if missing := [r.name for r in rules if not r.tokens]:
        raise ValueError(f"rules without a literal token: {missing}")
    rows = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"))
    host, path, whole = parts(F.col("url"))
    urls = rows.select("url").distinct().select("url", whole.alias("whole"))
    urls = urls.withColumn("tokens", F.array_distinct(F.regexp_extract_all(_ascii_lower(F.col("whole")), F.lit(_TOKEN), F.lit(0))))
    fits = (
        urls.select("url", "whole", F.explode("tokens").alias("token"))
        .join(index(urls, rules), "token")
        .filter(F.regexp_like("whole", F.col("pattern")))
    )
    # max of (length, name): the longest rule, of equally long ones the last by name.
    rank = F.struct("length", "name", "action")
    best = fits.groupBy("url").agg(F.max(F.when(F.col("site"), rank)).alias("s"), F.max(F.when(~F.col("site"), rank)).alias("p"))
    return rows.join(best, "url", "left").select(
        "page_id",
        host.alias("host"),
        path.alias("path"),
        F.col("s.name").alias("rule"),
        F.coalesce("s.action", "p.action", F.lit(default)).alias("verdict"),
        F.when(F.col("s").isNull(), F.col("p.name")).alias("pattern"),
    )
