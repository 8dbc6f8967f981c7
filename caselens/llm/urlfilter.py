"""URL filter: pattern rules found by their rarest literal token, then tried as expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.llm.common import lower_ascii

ALLOW, BLOCK = "allow", "block"
TOKEN = "[0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    """A pattern over ``host + path``. ``rank`` decides between fitting rules, the larger wins.

    ``literals`` are whole tokens that any address the pattern fits must contain; a rule without
    one is tried on every address. A ``silent`` rule gives its verdict only, not its name.
    """

    name: str
    pattern: str
    verdict: str
    literals: tuple[str, ...]
    rank: int
    silent: bool = False


def site_rule(site: str, verdict: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the path starts with the rule's.

    The rule's rank is its length. The last token of its path may go on in an address, so it only
    counts as a literal when a separator follows.
    """
    host, slash, rest = site.partition("/")
    path = slash + rest
    whole = re.findall(f"{TOKEN}(?![0-9A-Za-z])", path) if path else []
    if whole and not path.endswith("/") and path.endswith(whole[-1]):
        whole = whole[:-1]
    pattern = rf"^(?:[^/]*\.)?{re.escape(host.lower())}{re.escape(path) or '(?:/|$)'}"
    return Rule(site, pattern, verdict, (*re.findall(TOKEN, host.lower()), *whole), len(site))


def host_rule(words: str, verdict: str) -> Rule:
    """Fits a host that has these words, joined by hyphens as given, as whole words of a label.

    It has no name in the result and only counts where no site rule fits.
    """
    pattern = rf"^(?:[^/]*[.-])?{re.escape(words)}(?:[.-][^/]*)?(?:/|$)"
    return Rule(words, pattern, verdict, tuple(re.findall(TOKEN, words)), 0, silent=True)


# The site rules of the registered query, and words of spam hosts, which count where none fits.
SITES = (
    site_rule("org/", ALLOW),
    site_rule("example.org/es/", BLOCK),
    site_rule("example.org/en/1", BLOCK),
    site_rule("com/fr/", ALLOW),
    site_rule("com/de/", BLOCK),
)
SPAM_HOSTS = tuple(
    host_rule(words, BLOCK)
    for words in ("casino", "bets", "pills", "viagra", "spam", "adult", "xxx", "porn", "ads-track")
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lowered; empty for NULL or without ``://``."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    rows = [
        (r.name, r.pattern, r.verdict, list(dict.fromkeys(r.literals)), r.rank, r.silent)
        for r in rules
    ]
    return spark.createDataFrame(
        rows,
        "name string, pattern string, rule_verdict string, literals array<string>, rank int, "
        "silent boolean",
    )


def judge(pages: DataFrame, rules: tuple[Rule, ...], default: str = ALLOW) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row of ``pages (page_id, url, ...)``.

    Each rule is indexed by whichever of its literal tokens the fewest addresses have, counted over
    all addresses; an address fetches the rules of its tokens and only these are tried as regular
    expressions (a rule without literals is tried on all). Of the rules that fit, the highest rank
    wins, then block, then the smallest name; without one the verdict is ``default``. Equal
    addresses are judged once. A NULL url, or one without ``://``, has empty parts. Repeated rows
    stay repeated, other columns are not looked at, no rows give none.
    """
    placed = pages.select(
        F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("address", F.concat("host", "path"))
    addresses = placed.select("address").distinct()
    found = F.regexp_extract_all("address", F.lit(f"({TOKEN})"), F.lit(1))
    tokens = addresses.select("address", F.explode(F.array_distinct(found)).alias("token"))

    table = _rule_table(pages.sparkSession, rules)
    literals = table.select("name", F.explode("literals").alias("token"))
    counted = tokens.join(literals.select("token").distinct(), "token").groupBy("token").count()
    rarity = F.struct(F.coalesce("count", F.lit(0)).alias("addresses"), "token")
    rarest = literals.join(counted, "token", "left").groupBy("name").agg(
        F.min(rarity)["token"].alias("token")
    )
    fetched = tokens.join(table.join(rarest, "name"), "token").drop("token", "literals")
    for rule in rules:
        if not rule.literals:
            fetched = fetched.unionByName(
                addresses.withColumns(
                    {
                        "name": F.lit(rule.name),
                        "pattern": F.lit(rule.pattern),
                        "rule_verdict": F.lit(rule.verdict),
                        "rank": F.lit(rule.rank),
                        "silent": F.lit(rule.silent),
                    }
                )
            )
    order = F.struct(
        (-F.col("rank")).alias("order"),
        F.when(F.col("rule_verdict") == BLOCK, 0).otherwise(1).alias("mild"),
        "name", "rule_verdict", "silent",
    )
    best = (
        fetched.filter(F.expr("address RLIKE pattern"))
        .groupBy("address")
        .agg(F.min(order).alias("best"))
    )
    return placed.join(best, "address", "left").select(
        "page_id", "host", "path",
        F.when(~F.col("best.silent"), F.col("best.name")).alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
