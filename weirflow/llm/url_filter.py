"""URL filters: rules indexed by their rarest literal token.

A rule is a host with a path, or a pattern. Each has literal tokens, and any URL it fits
has all of them. How often each of these tokens stands in the URLs at hand is counted in
one pass; a rule is then indexed under its rarest token only. The tokens of a URL fetch
its candidate rules by an equality join with that index, and only those run their
regular expressions. A rule without any literal token, as of a host without ASCII letters and
digits, is indexed under a token that every URL has. Rules are broadcast in blocks of
``RULES``; the winner among all is taken over the blocks. Each different URL is judged once; the
verdicts of those that hold more than a partition's share of the rows, fewer than there are partitions, are broadcast
to the rows, so that no task has all rows of one URL.

Host rules fit a host and all its subdomains if the path starts with theirs, the longest
wins, and they settle the verdict. Otherwise a blocking pattern that fits blocks, else
the URL is allowed.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule
and is allowed; of rules that are equally long the first in order wins; equal rows are
judged alike, each on its own; an empty rule list allows all; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import shuffle_width, stored

RULES = 10_000  # of a block
EVERY = ""  # the token that every URL has
TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class HostRule:
    """Allows or blocks a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def expression(self) -> str:
        """On the host; the path is compared as it is."""
        return rf"(?s)^(?:.*\.)?{re.escape(self.host)}\z"

    @property
    def tokens(self) -> list[str]:
        # the host's labels are whole tokens; of the path only those that end within it
        inner = re.findall(rf"(?<![a-z0-9]){TOKEN}(?=[^a-z0-9])", self.path.lower())
        return re.findall(TOKEN, self.host) + inner


@dataclass(frozen=True)
class PatternRule:
    """Blocks URLs in which ``words`` stand as whole tokens, in order, with any one mark between them."""

    words: str

    @property
    def name(self) -> str:
        return self.words

    path = ""

    @property
    def expression(self) -> str:
        """On the URL in lower case."""
        return rf"(^|[^a-z0-9]){'[^a-z0-9]'.join(map(re.escape, self.words.split()))}([^a-z0-9]|$)"

    @property
    def tokens(self) -> list[str]:
        return self.words.split()


#: Blocking patterns for hosts and paths of advertising, tracking, betting and adult sites.
PATTERNS = tuple(
    PatternRule(words)
    for words in (
        "ads", "ad server", "ads track", "adserver", "doubleclick", "tracker", "tracking pixel", "banner ads",
        "free bets", "bets", "casino", "poker", "slots", "jackpot", "sportsbook", "payday loans",
        "porn", "xxx", "adult", "sex", "escort", "nude", "cheap pills", "viagra", "malware", "phishing",
        "warez", "torrent", "crack keygen", "spam", "click bait", "clickbait",
    )
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def tokens_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})")))


def index(rules: list, frequencies: dict[str, int]) -> list[tuple[int, str]]:
    """Per rule its position and rarest token, ties by name; without any token, that of every URL."""
    return [
        (k, min(rule.tokens, key=lambda t: (frequencies.get(t, 0), t), default=EVERY)) for k, rule in enumerate(rules)
    ]


def judge(pages: DataFrame, hosts: list[HostRule], patterns: tuple[PatternRule, ...] = PATTERNS) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, pattern."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("url"))
    # one row per different host, path and url to judge: repeated and hot URLs are judged once
    urls = stored(urls, "urls")
    distinct = urls.groupBy("host", "path", "url").agg(F.count("*").alias("rows"))
    rules = [*hosts, *patterns]
    literal = spark.createDataFrame([(t,) for t in {t for r in rules for t in r.tokens}], "token STRING")
    tokens = tokens_of(F.concat_ws(" ", "host", "path", "url"))
    counts = distinct.select(F.explode(tokens).alias("token")).join(F.broadcast(literal), "token", "left_semi")
    frequencies = {r["token"]: r["count"] for r in counts.groupBy("token").count().collect()}  # tokens of rules only
    entries = index(rules, frequencies)
    order = F.struct(F.length("name").alias("n"), (-F.col("position")).alias("p"), F.col("name"), F.col("rule_verdict"))
    found = []
    for start in range(0, len(entries), RULES):
        block = spark.createDataFrame(
            [
                (token, k, isinstance(rules[k], HostRule), rules[k].name, rules[k].path,
                 getattr(rules[k], "verdict", "block"), rules[k].expression)
                for k, token in entries[start : start + RULES]
            ],
            "token STRING, position INT, is_host BOOLEAN, name STRING, rule_path STRING, rule_verdict STRING, expression STRING",
        )
        every = any(token == EVERY for _, token in entries[start : start + RULES])
        own = F.array_append(tokens, F.lit(EVERY)) if every else tokens
        candidates = distinct.select("host", "path", "url", F.explode(own).alias("token")).join(F.broadcast(block), "token")
        fits = F.when(F.col("is_host"), F.expr("startswith(path, rule_path) AND host RLIKE expression")).otherwise(
            F.expr("lower(url) RLIKE expression")
        )
        found.append(candidates.filter(fits).select(
            "host", "path", "url", F.when(F.col("is_host"), order).alias("best"),
            F.when(~F.col("is_host"), F.col("name")).alias("pattern"), F.lit(0).cast("bigint").alias("rows"),
        ))
    # how many rows a URL has goes with its winners
    sized = distinct.select(
        "host", "path", "url", F.lit(None).cast("struct<n:int,p:int,name:string,rule_verdict:string>").alias("best"),
        F.lit(None).cast("string").alias("pattern"), "rows",
    )
    judged = stored(
        reduce(DataFrame.unionByName, found, sized).groupBy("host", "path", "url").agg(
            F.max("best").alias("best"), F.min("pattern").alias("pattern"), F.max("rows").alias("rows")
        ),
        "judged",
    )
    share = judged.agg((F.sum("rows") / shuffle_width(spark)).alias("share")).first()["share"] or 0.0
    is_hot = F.col("rows") > max(share, 1.0)
    hot = judged.filter(is_hot).select(
        *(F.col(c).alias(f"hot_{c}") for c in ("host", "path", "url", "best", "pattern"))
    )  # fewer than partitions
    same = [urls[c] == F.col(f"hot_{c}") for c in ("host", "path", "url")]
    marked = urls.join(F.broadcast(hot), same, "left")
    in_hot = marked.filter("hot_url IS NOT NULL").select(
        "page_id", "host", "path", F.col("hot_best").alias("best"), F.col("hot_pattern").alias("pattern")
    )
    rest = marked.filter("hot_url IS NULL").select("page_id", "host", "path", "url").join(
        judged.filter(~is_hot).drop("rows"), ["host", "path", "url"]
    ).select("page_id", "host", "path", "best", "pattern")
    return in_hot.unionByName(rest).select(
        "page_id", "host", "path", F.col("best.name").alias("rule"),
        F.coalesce("best.rule_verdict", F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("best").isNull(), F.col("pattern")).alias("pattern"),
    )
