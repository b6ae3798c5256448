"""URL filter: rules first, then empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host, registered domain and suffix.  Each level is a
beta-binomial whose prior mean is the posterior mean of the level above and whose prior
strength is fitted to the spread of that level's rates by moments.  A page that no rule
decides is blocked when even the lower posterior bound of its host's share of bad pages is above a limit.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import Stages, ascii_lower

#: Public suffixes of two labels that count as one suffix; pass your own list where it matters.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "co.in", "co.za")

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none fits.

    A rule fits its host and all subdomains when the path starts with the rule's path.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*suffixes), F.substring_index(host, ".", -3)
                  ).otherwise(F.substring_index(host, ".", -2))


def _strength(level: DataFrame) -> float:
    """Prior strength by moments, from ``n``, ``bad`` and the prior mean ``prior`` of each group.

    With rate r, E[n (r - p)^2] = p (1 - p) (1 + (n - 1) rho); strength is 1 / rho - 1.
    """
    spread = F.col("n") * (F.col("bad") / F.col("n") - F.col("prior")) ** 2
    unit = F.col("prior") * (1 - F.col("prior"))
    row = level.where("n > 0").agg(F.sum(spread - unit), F.sum((F.col("n") - 1) * unit)).first()
    if not row[1] or row[1] <= 0:
        return 1.0
    rho = min(max(row[0] / row[1], 1e-3), 1 / 3)  # a prior weighs two pages at least
    return 1 / rho - 1


def host_reputation(outcomes: DataFrame, hosts: DataFrame, stages: Stages, suffixes: Sequence[str] = SUFFIXES,
                    z: float = 1.6449) -> DataFrame:
    """``host, n, bad, mean, lower, upper`` for every host of ``hosts(host)``.

    ``outcomes(host, bad)`` holds one labelled page per row, ``bad`` 0 or 1; rows with a null in
    either column do not count.  A host without labelled pages gets its domain's posterior, a
    domain without any its suffix's, a suffix without any the overall rate (1/2 when there are no labels).
    The bounds are mean -/+ ``z`` standard deviations of the beta posterior, kept in [0, 1].
    """
    # Counts are summed before the join, so a host with a third of all pages is one short row.
    counts = (outcomes.where(F.col("host").isNotNull() & F.col("bad").isNotNull()).groupBy("host")
              .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("double")).alias("bad")))
    table = (hosts.select("host").where("host is not null").distinct().join(counts, "host", "full")
             .select("host", domain_of(F.col("host"), suffixes).alias("domain"),
                     suffix_of(F.col("host"), suffixes).alias("suffix"),
                     F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0.0)).alias("bad")))
    table = stages.write(table, "hosts")
    all_n, all_bad = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0.0))).first()
    overall = (all_bad + 0.5) / (all_n + 1)

    def posterior(level: DataFrame, key: str) -> DataFrame:
        strength = _strength(level)
        mean = (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)
        return level.withColumns({f"{key}_mean": mean, "mass": F.col("n") + strength})

    sums = F.sum("n").alias("n"), F.sum("bad").alias("bad")
    suffix = posterior(table.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall)), "suffix")
    suffix = suffix.select("suffix", F.col("suffix_mean").alias("prior"))
    domain = posterior(table.groupBy("suffix", "domain").agg(*sums).join(suffix, "suffix"), "domain")
    domain = stages.write(domain.select("suffix", "domain", F.col("domain_mean").alias("prior")), "domains")
    host = posterior(table.join(domain, ["suffix", "domain"]), "host")
    deviation = F.sqrt(F.col("host_mean") * (1 - F.col("host_mean")) / (F.col("mass") + 1))
    return host.select("host", "n", "bad", F.col("host_mean").alias("mean"),
                       F.greatest(F.col("host_mean") - z * deviation, F.lit(0.0)).alias("lower"),
                       F.least(F.col("host_mean") + z * deviation, F.lit(1.0)).alias("upper"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], limit: float = 0.3,
               suffixes: Sequence[str] = SUFFIXES, z: float = 1.6449) -> DataFrame:
    """``page_id, host, path, rule, verdict, mean, lower`` for every row of ``pages(page_id, url)``.

    ``outcomes(url, bad)`` are labelled pages.  The longest fitting rule decides; else the verdict is
    ``block`` when the lower bound of the host's bad share is above ``limit``, and ``allow`` otherwise.
    Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and
    is judged as the host ``''``; repeated rows are judged row by row; empty tables give no rows; without any
    labels every page that no rule decides is allowed; other columns are ignored.
    """
    stages = Stages(pages.sparkSession, "host-reputation")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    labelled = outcomes.select(F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), "bad")
    reputation = host_reputation(labelled, rows, stages, suffixes, z).select("host", "mean", "lower")
    reputation = stages.write(reputation, "reputation")
    stages.drop("hosts", "domains")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("lower") > limit, "block").otherwise("allow")
    return (rows.join(reputation, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
                    "mean", "lower"))
