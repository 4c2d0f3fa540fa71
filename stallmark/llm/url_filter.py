"""URL rules and empirical-Bayes host reputation, in DataFrame operations only.

Rules (host, path) decide the pages that they fit. Each such page is a labelled outcome (blocked
or allowed) of its host. Hosts lie in registered domains (the last two labels), these in suffixes
(the last label). Counts of outcomes are shrunk level by level with beta-binomial priors:
a suffix towards the share over all pages, a domain towards its suffix, a host towards its domain.
How strongly children lean on their parent is estimated from the spread of their shares by
the method of moments. A page without a rule is blocked if a lower posterior bound of its host's
share of blocked pages (mean less z standard deviations) is above a threshold.

Urls are parsed and judged by the rules once, and what is found is stored for the passes that follow. The table of hosts
is stored too, as are the levels above it; their moments are one row each, read as literals. Pages of the at most HOT_HOSTS busiest hosts get their verdict by a broadcast, other pages without
a rule by a join, pages with a rule by neither.

Defined cases: a null url, or one without `://`, has an empty host and path and counts as a host
of its own; urls of any length are read whole; a repeated page counts each time; a null page_id is kept; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: The rules of the contract: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
Z = 1.645
THRESHOLD = 0.5
#: A host is hot if it has more than this share of the pages without a rule: so at most HOT_HOSTS are.
HOT_HOSTS = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host and the path of a url by the contract's definition."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    host = F.translate(raw, _UPPER, _LOWER)
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict (both null without a rule)."""
    host, path = host_and_path(F.col("url"))
    own = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later, longer rules win
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return own.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def concentration(children: DataFrame, parent: str) -> float:
    """How many outcomes the parent's share is worth, from children with n, x and the parent's share."""
    n, x, m = F.col("n"), F.col("x"), F.col(parent)
    # Pooled moments: E (x/n - m)^2 = m (1 - m) (1/n + (1 - 1/n) / (k + 1)).
    spread = F.coalesce(F.sum(n * (x / n - m) * (x / n - m)), F.lit(0.0))
    base = F.coalesce(F.sum(m * (1 - m)), F.lit(0.0))
    more = F.coalesce(F.sum((n - 1) * m * (1 - m)), F.lit(0.0))
    rho = (spread - base) / F.when(more > 0, more)
    share = F.least(F.greatest(F.coalesce(rho, F.lit(0.5)), F.lit(0.001)), F.lit(0.5))
    return children.where("n > 0").agg((1 / share - 1).alias("k")).first().k


def shrunk(level: DataFrame, parent: str, to: str) -> tuple[DataFrame, float]:
    """The level with its posterior mean, and how many outcomes the parent's share was worth."""
    k = concentration(level, parent)
    return level.withColumn(to, (F.col("x") + k * F.col(parent)) / (F.col("n") + k)), k


def reputation(judged_pages: DataFrame) -> DataFrame:
    """host, n, x, free (pages without a rule), mean, bound: the posterior of each host's share of blocked pages."""
    hosts = judged_pages.groupBy("host").agg(
        F.count("rule_verdict").cast("double").alias("n"),
        F.sum(F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0)).alias("x"),
        F.count(F.when(F.col("rule_verdict").isNull(), 1)).alias("free"),
    )
    hosts = hosts.withColumn("suffix", F.element_at(F.split("host", r"\."), -1)).withColumn("domain", F.substring_index("host", ".", -2))
    hosts = written(hosts, "hosts")
    domains = written(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "domains")
    suffixes = written(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "suffixes")
    top = suffixes.agg(((F.coalesce(F.sum("x"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2)).alias("mean")).first().mean
    s, _ = shrunk(suffixes.withColumn("all_mean", F.lit(top)), "all_mean", "suffix_mean")
    d, _ = shrunk(written(domains.join(s.select("suffix", "suffix_mean"), "suffix"), "domains"), "suffix_mean", "domain_mean")
    h, k = shrunk(written(hosts.join(d.select("domain", "domain_mean"), "domain"), "hosts"), "domain_mean", "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + k + 1))
    return h.select("host", "n", "x", "free", "mean", (F.col("mean") - Z * deviation).alias("bound"))


def url_filter(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict for every page."""
    own = written(judged(pages, rules), "judged")
    verdicts = written(reputation(own).where("free > 0").select("host", "free", F.when(F.col("bound") > threshold, "block").otherwise("allow").alias("host_verdict")), "verdicts")
    free = verdicts.agg(F.sum("free")).first()[0] or 0
    is_hot = F.col("free") * HOT_HOSTS > free
    ruled = own.where("rule is not null").withColumn("verdict", F.col("rule_verdict"))
    left = own.where("rule is null")
    hot = left.join(F.broadcast(verdicts.where(is_hot)), "host")  # fewer than HOT_HOSTS rows
    rest = left.join(F.broadcast(verdicts.where(is_hot).select("host")), "host", "left_anti").join(verdicts.where(~is_hot), "host")
    out = [part.withColumn("verdict", F.col("host_verdict")) for part in (hot, rest)]
    return functools.reduce(DataFrame.unionByName, [part.select("page_id", "host", "path", "rule", "verdict") for part in (ruled, *out)])


ORACLE_SQL = """
WITH split_url AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw,
    coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path FROM split_url
), hosted AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM hosted
), outcome AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS rule_verdict FROM ruled
), hosts AS (
  SELECT host, CAST(count(rule_verdict) AS DOUBLE) AS n, CAST(sum(CASE WHEN rule_verdict = 'block' THEN 1 ELSE 0 END) AS DOUBLE) AS x,
    split_part(host, '.', -1) AS suffix,
    CASE WHEN length(host) - length(replace(host, '.', '')) >= 1 THEN split_part(host, '.', -2) || '.' || split_part(host, '.', -1) ELSE host END AS domain
  FROM outcome GROUP BY host
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM domains GROUP BY suffix),
s0 AS (SELECT *, (SELECT (sum(x) + 1) / (sum(n) + 2) FROM suffixes) AS m FROM suffixes),
sk AS (SELECT 1 / least(greatest(coalesce((sum(n * (x / n - m) * (x / n - m)) - sum(m * (1 - m))) / nullif(sum((n - 1) * m * (1 - m)), 0), 0.5), 0.001), 0.5) - 1 AS k FROM s0 WHERE n > 0),
s1 AS (SELECT suffix, (x + k * m) / (n + k) AS m FROM s0, sk),
d0 AS (SELECT domains.*, m FROM domains JOIN s1 USING (suffix)),
dk AS (SELECT 1 / least(greatest(coalesce((sum(n * (x / n - m) * (x / n - m)) - sum(m * (1 - m))) / nullif(sum((n - 1) * m * (1 - m)), 0), 0.5), 0.001), 0.5) - 1 AS k FROM d0 WHERE n > 0),
d1 AS (SELECT domain, (x + k * m) / (n + k) AS m FROM d0, dk),
h0 AS (SELECT hosts.*, m FROM hosts JOIN d1 USING (domain)),
hk AS (SELECT 1 / least(greatest(coalesce((sum(n * (x / n - m) * (x / n - m)) - sum(m * (1 - m))) / nullif(sum((n - 1) * m * (1 - m)), 0), 0.5), 0.001), 0.5) - 1 AS k FROM h0 WHERE n > 0),
h1 AS (SELECT host, n, k, (x + k * m) / (n + k) AS p FROM h0, hk),
h2 AS (SELECT host, CASE WHEN p - 1.645 * sqrt(p * (1 - p) / (n + k + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS host_verdict FROM h1)
SELECT page_id, host, path, rule, coalesce(rule_verdict, host_verdict) AS verdict FROM outcome JOIN h2 USING (host)
"""
