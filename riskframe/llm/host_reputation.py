"""URL filters: rules first, else an empirical-Bayes reputation shrunk from suffix to domain to host."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import settle

#: (verdict, rule); a rule is a host with all its subdomains and a path prefix.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: A page is a bad outcome from this share of mark-up symbols in its visible text on.
BAD_SHARE = 0.05
#: A host is blocked if its bad share is above the limit with this many standard deviations to spare.
LIMIT, DEVIATIONS = 0.5, 1.645
LEVELS = ("suffix", "domain", "host")


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z in lower case) and ``path``; both empty without ``://`` or for a null url."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def rule_columns(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for outcome, text in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):
        host, slash, path = text.partition("/")
        fits = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
        fits = fits & F.startswith(F.col("path"), F.lit(slash + path))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return rule, verdict


def with_levels(df: DataFrame) -> DataFrame:
    """Adds ``domain`` (the last two labels of a host; all of an address) and ``suffix`` (the last label)."""
    address = F.col("host").rlike(r"^[0-9.]+(:\d+)?$|^\[")
    name = F.regexp_replace("host", r"^.*@|:\d*$", "")
    domain = F.when(address, F.col("host")).otherwise(F.substring_index(name, ".", -2))
    suffix = F.when(address, F.lit("")).otherwise(F.substring_index(name, ".", -1))
    return df.withColumns({"domain": domain, "suffix": suffix})


def page_outcomes(pages: DataFrame, html_col: str = "html", bad_share: float = BAD_SHARE) -> DataFrame:
    """Adds ``bad``: 1 for a page whose visible text is strewn with symbols, 0 for another, null without html."""
    visible = F.regexp_replace(html_col, r"(?is)<(script|style)\b.*?</\1>|<[^>]*>|&[a-z]+;|\s+", "")
    symbols = F.length(visible) - F.length(F.translate(visible, "%$#&*!|~^=", ""))
    share = F.when(F.length(visible) > 0, symbols / F.length(visible)).otherwise(F.lit(0.0))
    return pages.withColumn("bad", F.when(F.col(html_col).isNotNull(), (share >= bad_share).cast("int")))


def _precision(groups: DataFrame) -> float:
    """Weight of the prior, in pages: moments of beta-binomial counts ``n, k`` around the prior mean ``mu``."""
    spread = F.greatest(F.col("mu") * (1 - F.col("mu")), F.lit(1e-9))
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("mu"), 2)).alias("s"),
        F.sum(spread).alias("v"), F.sum((F.col("n") - 1) * spread).alias("w")).first()
    if row["s"] is None or not row["w"]:
        return 10.0
    rho = min(max((row["s"] - row["v"]) / row["w"], 1e-4), 0.99)
    return 1 / rho - 1


def reputations(labelled: DataFrame) -> DataFrame:
    """``host, n, mean, low, high`` for each host of ``labelled`` (``host``, ``bad``; null outcomes count as unseen).

    Each level's bad share is a beta-binomial whose prior mean is the posterior mean of
    the level above and whose prior weight comes from the moments of that level: hosts
    shrink to registered domains, these to suffixes, these to the whole. The counts of the
    hosts are written once, so pages are read once for all levels. ``low`` and
    ``high`` lie ``DEVIATIONS`` posterior standard deviations from the mean. Only counts
    are shuffled, summed before the shuffle; three numbers reach the driver.
    """
    counts = with_levels(labelled.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k")))
    counts = settle(labelled.sparkSession, counts, "hosts")
    whole = counts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    above = F.lit(((whole["k"] or 0) + 1) / ((whole["n"] or 0) + 2))
    upper = None
    for level in LEVELS:
        keys = list(LEVELS[:LEVELS.index(level) + 1])
        groups = counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        groups = groups.withColumn("mu", above) if upper is None else groups.join(upper, keys[:-1])
        weight = _precision(groups)
        a, b = F.col("k") + weight * F.col("mu"), F.col("n") - F.col("k") + weight * (1 - F.col("mu"))
        groups = groups.withColumns({"mean": a / (a + b), "sd": F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))})
        upper = groups.select(*keys, F.col("mean").alias("mu"))
    return groups.select(
        "host", "n", "mean", F.greatest(F.col("mean") - DEVIATIONS * F.col("sd"), F.lit(0.0)).alias("low"),
        F.least(F.col("mean") + DEVIATIONS * F.col("sd"), F.lit(1.0)).alias("high"))


def filter_urls(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id", url_col: str = "url", limit: float = LIMIT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_share, bad_low`` for each row of ``pages``.

    ``labelled`` has ``host`` and ``bad``; without it the outcomes are read off the html of
    ``pages``. A rule's verdict stands; any other page is blocked if the lower posterior
    bound of its host's bad share is above ``limit``. Null urls and urls without ``://`` share the empty
    host. Repeated rows are judged each, null ids stay null, other columns are ignored,
    an empty table gives an empty result. A host that no labelled page has is allowed.
    """
    parsed = with_host_and_path(pages, url_col)
    if labelled is None:
        labelled = page_outcomes(parsed.select("host", "html")).select("host", "bad")
    scores = reputations(labelled).select(F.col("host").alias("__host"), "mean", "low")
    rule, verdict = rule_columns(rules)
    out = parsed.select(F.col(id_col).alias("page_id"), "host", "path").join(
        scores, F.col("host") == F.col("__host"), "left")
    own = F.when(F.col("low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                      F.col("mean").alias("bad_share"), F.col("low").alias("bad_low"))
