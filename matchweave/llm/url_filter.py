"""URL verdicts from pattern rules that are looked up by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of rule tokens up to which the rule index is broadcast; a larger one is joined by shuffle.
BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    """One rule over ``host`` + ``path``.

    ``tokens`` are words (runs of a-z and 0-9) that every URL the pattern fits contains as whole tokens. Among rules
    that fit, the highest ``rank`` wins, then the longest ``name``, then the last name in order. ``shown`` rules are named in the result.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 0
    shown: bool = False


def site_rule(verdict: str, site: str) -> Rule:
    """A rule ``host/path`` for a host, its subdomains and all paths that begin with the given one."""
    host, slash, path = site.partition("/")
    path = slash + path
    # the last path word may go on in the URL, so it is a whole token only if the path ends in a separator
    words = re.findall(r"[a-z0-9]+", host) + re.findall(r"[a-z0-9]+(?=[^A-Za-z0-9])", path)
    return Rule(site, verdict, rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(words), rank=1, shown=True)


def word_rule(word: str) -> Rule:
    """Block a URL that has ``word`` as a whole token of its host or path."""
    return Rule(word, "block", rf"(?i)(^|[^a-z0-9]){re.escape(word)}([^a-z0-9]|$)", (word,))


#: The rules of the registered query: sites first, then words that mark unwanted pages.
SITES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UNWANTED = ("adult", "bet", "casino", "escort", "gambling", "poker", "porn", "sex", "xxx")
RULES = tuple(site_rule(*site) for site in SITES) + tuple(word_rule(word) for word in UNWANTED)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null URL or one without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.regexp_replace(whole, r"(?s)^.*?://", "")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def tokens(text: Column) -> Column:
    """Distinct runs of letters and digits, A-Z in lower case."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit("[a-z0-9]+"), F.lit(0)))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """The rules as rows ``_name, _verdict, _pattern, _tokens, _rank, _shown``."""
    rows = [
        F.struct(
            F.lit(r.name).alias("_name"),
            F.lit(r.verdict).alias("_verdict"),
            F.lit(r.pattern).alias("_pattern"),
            F.array(*map(F.lit, r.tokens)).alias("_tokens"),
            F.lit(r.rank).alias("_rank"),
            F.lit(r.shown).alias("_shown"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def rule_index(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under the one of its tokens that the fewest addresses hold (ties: the first in order)."""
    wanted = rules.select("_name", F.explode("_tokens").alias("_token"))
    seen = addresses.select(F.explode(tokens(F.concat_ws("/", "_host", "_path"))).alias("_token"))
    counts = seen.join(F.broadcast(wanted.select("_token").distinct()), "_token", "left_semi").groupBy("_token").agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranked = wanted.join(counts, "_token", "left").groupBy("_name").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_token")).alias("_rarest")
    )
    return rules.join(ranked, "_name").select("_name", "_verdict", "_pattern", "_rank", "_shown", F.col("_rarest._token").alias("_token"))


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow", url: str = "url", keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """``keep`` columns, ``host, path, rule, verdict`` of every row of ``pages``.

    Each rule is filed under its rarest literal token. The tokens of a URL fetch the rules filed under them, and only
    those run their regular expression; of the rules that fit, the highest ranked and then the longest decides.
    ``rule`` names it if it is a shown (site) rule and is null otherwise; ``default`` is the verdict where none fits.

    A null URL, an empty one or one without ``://`` has an empty host and path and gets the default. Every row is
    answered, repeated rows and repeated ids too; an empty table gives no rows; other columns are left alone. Distinct
    addresses are judged once, so a URL that fills a large share of the table costs no more than another.
    """
    if not rules or not all(r.tokens for r in rules):
        raise ValueError("every rule needs a literal token")
    host, path = host_and_path(F.col(url))
    rows = pages.select(*keep, host.alias("_host"), path.alias("_path"))
    addresses = rows.filter("_host <> '' or _path <> ''").select("_host", "_path").distinct()
    index = rule_index(addresses, rule_table(pages.sparkSession, rules))
    if sum(len(r.tokens) for r in rules) <= BROADCAST_RULES:
        index = F.broadcast(index)

    asked = addresses.select("_host", "_path", F.explode(tokens(F.concat_ws("/", "_host", "_path"))).alias("_token"))
    fitting = asked.join(index, "_token").filter(F.expr("concat(_host, _path) rlike _pattern"))
    best = F.max_by(
        F.struct("_name", "_verdict", "_shown"),
        F.struct("_rank", F.length("_name"), "_name"),
    )
    judged = fitting.groupBy("_host", "_path").agg(best.alias("_best"))
    return rows.join(judged, ["_host", "_path"], "left").select(
        *keep,
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.when(F.col("_best._shown"), F.col("_best._name")).alias("rule"),
        F.coalesce("_best._verdict", F.lit(default)).alias("verdict"),
    )
