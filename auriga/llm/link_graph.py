"""URL filters: rules by host and path, and trust and distrust propagated over the graph of hosts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auriga.llm.common import ascii_lower, cut, keep, text_of

DAMPING = 0.85
ROUNDS = 20
# A host is blocked if its distrust exceeds its trust by what a host with this share of blocked pages starts with.
THRESHOLD = 0.5
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What follows the first :// up to a slash, question mark or hash, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark, a hash or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule], field: str) -> Column:
    """The text or verdict of the longest rule whose host is this one or a parent of it and whose path begins
    this one; null without any. The number of rules is a parameter's, not the data's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(str(rule) if field == "rule" else rule.verdict)).otherwise(found)
    return found


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    rounds: int = ROUNDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict.

    A page that a rule fits has the rule's verdict. Any other has its host's: allow, unless the host's
    distrust outweighs its trust. Trust is a personalised PageRank from hosts with allowed pages, along links;
    distrust one from hosts with blocked pages, against links: who links to bad hosts is suspect. A host's
    seed is the share of its pages that rules allow or block.

    A null url, or one without ://, has an empty host and path and no links or seeds. A null html has no
    links; only absolute links make edges. Repeated rows repeat, and count as pages each. Other columns
    are ignored. An empty table gives no rows.

    Links fold to distinct host pairs before the shuffle, so a host with most of the pages is one row per
    task; each round is one join and one sum by host.
    """
    url = F.col("url").cast("string")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    rows = rows.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules, "rule")).withColumn(
        "ruled", rule_for(F.col("host"), F.col("path"), rules, "verdict")
    )
    standing = propagate(seeds(rows), messages(host_links(pages)), rounds)
    against = F.col("distrust") > F.col("trust") + (1 - DAMPING) * threshold
    hosts = standing.select("host", F.when(against, "block").otherwise("allow").alias("verdict"))
    return rows.join(hosts, "host").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "verdict").alias("verdict")
    )


def seeds(rows: DataFrame) -> DataFrame:
    """host, trusted, distrusted: shares of the host's pages that rules allow and block."""
    return rows.groupBy("host").agg(
        F.avg(F.when(F.col("ruled") == "allow", 1.0).otherwise(0.0)).alias("trusted"),
        F.avg(F.when(F.col("ruled") == "block", 1.0).otherwise(0.0)).alias("distrusted"),
    )


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct (source, target) hosts of absolute links; links within a host make no edge."""
    found = pages.select(
        host_of(F.col("url").cast("string")).alias("source"),
        F.explode(F.regexp_extract_all(text_of("html"), F.lit(LINK), F.lit(1))).alias("link"),
    )
    target = host_of(F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    return (
        found.select("source", target.alias("target"))
        .filter("source <> '' AND target <> '' AND source <> target")
        .distinct()
    )


def messages(edges: DataFrame) -> DataFrame:
    """sender, receiver, trust, distrust: what a host passes on of its own trust and distrust.

    Trust is shared among the hosts a host links to, distrust among the hosts that link to it.
    """
    edges = keep(edges, "host-links")
    out = edges.groupBy("source").agg(F.count("*").alias("n"))
    into = edges.groupBy("target").agg(F.count("*").alias("n"))
    forward = edges.join(out, "source").select(
        F.col("source").alias("sender"), F.col("target").alias("receiver"), (1 / F.col("n")).alias("trust"),
        F.lit(0.0).alias("distrust"),
    )
    backward = edges.join(into, "target").select(
        F.col("target").alias("sender"), F.col("source").alias("receiver"), F.lit(0.0).alias("trust"),
        (1 / F.col("n")).alias("distrust"),
    )
    return forward.unionByName(backward)


def propagate(seed: DataFrame, passed: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """host, trust, distrust after the rounds; hosts that are only linked to have no seeds.

    Without edges a round changes nothing, so none is run.
    """
    passed = keep(passed, "host-messages")
    start = 1 - DAMPING
    state = seed.select("host", (start * F.col("trusted")).alias("trust"), (start * F.col("distrusted")).alias("distrust"))
    if passed.isEmpty():
        return state
    linked = passed.select(F.col("receiver").alias("host")).distinct()
    seed = keep(
        seed.join(linked, "host", "full").select(
            "host", F.coalesce("trusted", F.lit(0.0)).alias("trusted"),
            F.coalesce("distrusted", F.lit(0.0)).alias("distrusted"),
        ),
        "host-seeds",
    )
    state = seed.select("host", (start * F.col("trusted")).alias("trust"), (start * F.col("distrusted")).alias("distrust"))
    for number in range(1, rounds + 1):
        given = (
            passed.alias("m").join(state.alias("s"), F.col("m.sender") == F.col("s.host"))
            .groupBy(F.col("m.receiver").alias("host"))
            .agg(
                F.sum(F.col("m.trust") * F.col("s.trust")).alias("t"),
                F.sum(F.col("m.distrust") * F.col("s.distrust")).alias("d"),
            )
        )
        state = seed.join(given, "host", "left").select(
            "host",
            (start * F.col("trusted") + DAMPING * F.coalesce("t", F.lit(0.0))).alias("trust"),
            (start * F.col("distrusted") + DAMPING * F.coalesce("d", F.lit(0.0))).alias("distrust"),
        )
        if number % 5 == 0:
            state = cut(state)
    return state
