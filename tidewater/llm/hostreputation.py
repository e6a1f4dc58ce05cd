"""URL filters: rules first, then an empirical-Bayes reputation of the host.

Labelled pages are outcomes (good or bad). Their beta-binomial counts shrink
level by level: the suffix towards all pages, the registered domain towards its
suffix, the host towards its domain. Each level's prior strength is estimated by
the method of moments over all of the level's groups, so a host without labels
gets its domain's rate, and a host with many gets its own. A page passes unless
the upper posterior bound of its host's good rate lies below the wanted rate.

Built-in functions only. Counts are pre-aggregated per task; pages meet their
host's one row in an equi-join whose skew (one hot host) Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import ascii_lower, stored

#: (host, path, verdict): fits the host and its subdomains if the path starts with the rule's.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))

MIN_GOOD_RATE = 0.5
Z_BOUND = 1.645
MAX_STRENGTH = 1000.0
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits (of equal ones the first listed), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def group_of(host: Column, level: str) -> Column:
    """The host's suffix (last label), registered domain (last two), or the host."""
    if level == "host":
        return host
    return F.substring_index(host, ".", -1 if level == "suffix" else -2)


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, good) over labelled pages; a page is good if its labels say quality and never toxic.

    ``labels`` are matched by page_id = doc_id. Rows repeating an id count as
    one label, which is bad if any of them is; a null label value says nothing.
    """
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.where(F.col("doc_id").isNotNull() & bad.isNotNull())
    one = known.groupBy(F.col("doc_id").alias("page")).agg(F.max(bad.cast("int")).alias("bad"))
    hosts = pages.select(F.col("page_id").alias("page"), host_of(F.col("url")).alias("host")).where("host <> ''")
    return (hosts.join(one, "page").groupBy("host")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("bad")).alias("good")))


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the prior strength of a level, by moments over its labelled groups.

    ``groups`` has n, good and the parent's rate mu. With overdispersion rho
    between a group's outcomes, E[sum (good - n mu)^2] = sum n mu (1 - mu) (1 + (n - 1) rho),
    and the strength is 1 / rho - 1. Sums go over every group; no group of two: the maximum.
    """
    base = F.col("n") * F.col("mu") * (1 - F.col("mu"))
    sums = groups.agg(F.sum(F.pow(F.col("good") - F.col("n") * F.col("mu"), 2)).alias("got"),
                      F.sum(base).alias("binomial"), F.sum(base * (F.col("n") - 1)).alias("more"))
    rho = F.greatest(F.lit(1 / (MAX_STRENGTH + 1)), F.least(F.lit(0.5), (F.col("got") - F.col("binomial")) / F.col("more")))
    return sums.select(F.when(F.col("more") > 0, 1 / rho - 1).otherwise(MAX_STRENGTH).alias("strength"))


def reputations(counts: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, alpha, beta) of every host: the parameters of its posterior good rate.

    ``counts`` is what ``outcomes`` gives, ``hosts`` a table of distinct hosts.
    Without any label the rate is the uniform prior's, alpha = beta = 1.
    """
    groups = stored(hosts.join(counts, "host", "left").select(
        "host", *[group_of(F.col("host"), x).alias(x) for x in LEVELS[:-1]], "n", "good"), "hosts")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    mean = total.select(((F.col("good") + 1) / (F.col("n") + 2)).alias("rate"))
    above = None
    for level, parent in zip(LEVELS, (None, *LEVELS)):
        keys = [c for c in (parent, level) if c]
        here = groups.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if above is None:
            here = here.withColumn("mu", mean.scalar())
        else:
            here = here.join(above, parent)
        here = stored(here, level)
        strength = _strength(here.where(F.col("n") > 0)).scalar()
        good, seen = F.coalesce("good", F.lit(0)), F.coalesce("n", F.lit(0))
        here = (here.withColumn("alpha", F.col("mu") * strength + good)
                    .withColumn("beta", (1 - F.col("mu")) * strength + seen - good))
        above = here.select(F.col(level), (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("mu"))
    return here.select("host", "alpha", "beta")


def upper_bound(alpha: Column, beta: Column, z: float = Z_BOUND) -> Column:
    """The posterior mean plus z posterior standard deviations of a beta distribution."""
    n = alpha + beta
    return alpha / n + z * F.sqrt(alpha * beta / (n * n * (n + 1)))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, min_good_rate: float = MIN_GOOD_RATE) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, and the host's posterior (alpha, beta).

    A null url, or one without ``://``, has an empty host and path; an empty
    host has no reputation and is allowed. Repeated rows are judged alike.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = parts.where("host <> ''").select("host").distinct()
    known = reputations(outcomes(pages, labels), hosts)
    judged = parts.join(known, "host", "left").withColumn("m", matching_rule(F.col("host"), F.col("path"), rules))
    fair = F.coalesce(upper_bound(F.col("alpha"), F.col("beta")) >= min_good_rate, F.lit(True))
    return judged.select("page_id", "host", "path", F.col("m.rule").alias("rule"),
                         F.coalesce("m.verdict", F.when(fair, "allow").otherwise("block")).alias("verdict"),
                         "alpha", "beta")


_LEVEL_SQL = """
{l}_own AS (SELECT {g} AS g, sum(n) AS n, sum(good) AS good FROM counts GROUP BY 1),
{l}_all AS (SELECT DISTINCT {g} AS g, {pg} AS p FROM hosts),
{l}_mu AS (SELECT a.g, o.n, o.good, {mu} AS mu FROM {l}_all a LEFT JOIN {l}_own o USING (g) {join}),
{l}_k AS (SELECT CASE WHEN sum(n * mu * (1 - mu) * (n - 1)) > 0 THEN 1 / greatest(1 / 1001.0::DOUBLE, least(0.5,
    (sum(pow(good - n * mu, 2)) - sum(n * mu * (1 - mu))) / sum(n * mu * (1 - mu) * (n - 1)))) - 1
    ELSE 1000 END AS k FROM {l}_mu WHERE n > 0),
{l} AS (SELECT g, mu * k + coalesce(good, 0) AS alpha, (1 - mu) * k + coalesce(n - good, 0) AS beta,
    alpha / (alpha + beta) AS rate FROM {l}_mu, {l}_k),
"""


def _levels_sql() -> str:
    last = "regexp_extract(host, '[^.]*$')"
    two = "regexp_extract(host, '[^.]*[.]?[^.]*$')"
    out, parent = "", None
    for level, g in zip(LEVELS, (last, two, "host")):
        out += _LEVEL_SQL.format(
            l=level, g=g, pg={"suffix": "NULL", "domain": last, "host": two}[level],
            mu="(SELECT rate FROM top)" if parent is None else f"{parent}.rate",
            join="" if parent is None else f"JOIN {parent} ON {parent}.g = a.p")
        parent = level
    return out


URLS_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
hosts AS (SELECT DISTINCT host FROM parts WHERE host <> ''),
one AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
counts AS (SELECT host, count(*) AS n, sum(1 - bad) AS good
  FROM parts JOIN one ON doc_id = page_id WHERE host <> '' GROUP BY host),
top AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS rate FROM counts),
""" + _levels_sql() + r"""
rules AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) t(h, p, v)),
hit AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM parts JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY page_id)
SELECT parts.page_id, parts.host, parts.path, hit.rule,
  coalesce(hit.v, CASE WHEN host.g IS NULL OR rate + 1.645 * sqrt(alpha * beta
    / (pow(alpha + beta, 2) * (alpha + beta + 1))) >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM parts LEFT JOIN host ON host.g = parts.host LEFT JOIN hit USING (page_id)
"""
