"""URL filter by rules and empirical-Bayes host reputation.

Explicit rules (host and path prefix) come first; the longest that fits wins.
Where none fits, the host's reputation decides: the share of bad labelled
pages of a host is shrunk through beta-binomial priors from host to registered
domain to public suffix to all pages. How strongly each level is pulled to the
one above is estimated from the data (moments of the beta-binomial). A host is
blocked if the lower posterior bound of its bad share lies over the threshold.
All of it is grouped counts and equi-joins on the number of hosts, native.

A page's label is that of the document with its id; a page is bad if it is
toxic or of quality 0.

Edge cases: a null url or one without ``://`` has empty host and path (and so
belongs to the host ``''``); unlabelled hosts have the posterior of their
domain's prior; without any label the prior share is one half and everything
is allowed; repeated pages are judged each, repeated labels of a page all
count; ties between rules are impossible (the longest is unique per host and
path); empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import fold_ascii
from retail_lake.operators.stages import stage

#: Fixed values: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Public suffixes of two labels.
WIDE_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "net.au", "org.uk")
THRESHOLD = 0.5
Z = 1.645                  # one-sided 95 % bound
STRENGTH = (1.0, 1000.0)   # bounds of a prior's weight in pages

_WIDE = "|".join(s.replace(".", r"\.") for s in WIDE_SUFFIXES)
SUFFIX = rf"(?:^|\.)((?:{_WIDE})|[^.]+)$"
DOMAIN = rf"(?:^|\.)([^.]+\.(?:(?:{_WIDE})|[^.]+))$"


def split_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    at = F.instr(F.col(url_col), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    return (df.withColumn("__rest", rest)
              .withColumn("host", fold_ascii(F.regexp_extract("__rest", r"^([^/?#]*)", 1)))
              .withColumn("path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1)).drop("__rest"))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):       # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _strength(share: Column) -> Column:
    """Weight of the prior of one level's groups: moment estimate of the beta-binomial."""
    groups, pages = F.count("*"), F.sum("n").cast("double")
    spread = F.sum(F.col("n") * (F.col("k") / F.col("n") - share) * (F.col("k") / F.col("n") - share))
    noise = share * (1 - share)
    top = spread - noise * (groups - 1)
    bottom = noise * (pages - F.sum(F.col("n") * F.col("n")) / pages - (groups - 1))
    rho = F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
    kappa = F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(STRENGTH[1]))
    return F.coalesce(F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), kappa)), F.lit(STRENGTH[1]))


def host_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, k, bound) for every host of ``pages`` (page_id, host)."""
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    outcome = (labels.where(F.col("doc_id").isNotNull() & (F.col("toxic").isNotNull() | F.col("quality").isNotNull()))
                     .groupBy(F.col("doc_id").alias("page_id")).agg(F.count("*").alias("n"),
                                                                    F.sum(bad.cast("bigint")).alias("k")))
    hosts = (pages.join(outcome, "page_id", "left").groupBy("host")
                  .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")))
    bare = F.regexp_replace("host", ":[0-9]*$", "")
    domain = F.regexp_extract(bare, DOMAIN, 1)
    hosts = (hosts.withColumn("domain", F.when(domain == "", bare).otherwise(domain))
                  .withColumn("suffix", F.regexp_extract(bare, SUFFIX, 1)))
    hosts = stage(hosts, "hosts")                            # counted once, read by every level
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    # four numbers: the overall share and the weight of each level's prior
    share = F.lit(suffixes.agg((F.coalesce(F.sum("k"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).first()[0])
    levels = [level.where("n > 0").select(F.lit(name).alias("level"), "n", "k")
              for name, level in (("suffix", suffixes), ("domain", domains), ("host", hosts))]
    weight = dict(levels[0].union(levels[1]).union(levels[2]).groupBy("level").agg(_strength(share)).collect())
    w = {name: F.lit(weight.get(name, STRENGTH[1])) for name in ("suffix", "domain", "host")}

    def shrunk(level: str, prior: Column) -> Column:
        return (F.col("k") + w[level] * prior) / (F.col("n") + w[level])

    s = suffixes.select("suffix", shrunk("suffix", share).alias("share"))
    d = domains.join(s, "suffix").select("domain", shrunk("domain", F.col("share")).alias("share"))
    size = F.col("n") + w["host"]
    return (hosts.join(d, "domain").withColumn("mean", shrunk("host", F.col("share")))
            .withColumn("bound", F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1)))
            .select("host", "n", "k", "bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: id, host, path, rule, verdict."""
    split = split_url(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    reputation = host_reputation(split.select("page_id", "host"), labels).select("host", "bound")
    judged = split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    return (judged.join(reputation, "host", "left")
            .select(F.col("page_id").alias(id_col), "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("bound") > THRESHOLD, "block").otherwise("allow")).alias("verdict")))


ORACLE_SQL = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(kind, h, pre) AS (VALUES {", ".join(f"('{k}', '{h}', '{p}')" for k, h, p in RULES)}),
fit AS (
  SELECT page_id, host, path, arg_max(h || pre, length(h || pre)) AS rule, arg_max(kind, length(h || pre)) AS kind
  FROM (SELECT DISTINCT page_id, host, path FROM p) u
  JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre)
  GROUP BY page_id, host, path),
o AS (SELECT doc_id, count(*) AS n, sum((coalesce(toxic = 1, false) OR coalesce(quality = 0, false))::INT) AS k
      FROM labels WHERE toxic IS NOT NULL OR quality IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(k), 0)::DOUBLE AS k,
         regexp_replace(host, ':[0-9]*$', '') AS bare,
         regexp_extract(regexp_replace(host, ':[0-9]*$', ''), '{SUFFIX}', 1) AS suffix,
         coalesce(nullif(regexp_extract(regexp_replace(host, ':[0-9]*$', ''), '{DOMAIN}', 1), ''),
                  regexp_replace(host, ':[0-9]*$', '')) AS domain
  FROM p LEFT JOIN o ON p.page_id = o.doc_id GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
m AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS q FROM suffixes),
levels AS (SELECT 's' AS l, n, k FROM suffixes WHERE n > 0 UNION ALL
           SELECT 'd', n, k FROM domains WHERE n > 0 UNION ALL SELECT 'h', n, k FROM hosts WHERE n > 0),
rho AS (
  SELECT l, (sum(n * (k / n - q) * (k / n - q)) - any_value(q * (1 - q)) * (count(*) - 1)) AS top,
         any_value(q * (1 - q)) * (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)) AS bottom
  FROM levels, m GROUP BY l),
kappa AS (
  SELECT x.l, coalesce(greatest({STRENGTH[0]}, least({STRENGTH[1]},
              CASE WHEN bottom > 0 AND top / bottom > 0 THEN bottom / top - 1 ELSE {STRENGTH[1]} END)), {STRENGTH[1]})::DOUBLE AS w
  FROM (VALUES ('s'), ('d'), ('h')) x(l) LEFT JOIN rho USING (l)),
sm AS (SELECT suffix, (k + w * q) / (n + w) AS q FROM suffixes, m, kappa WHERE l = 's'),
dm AS (SELECT domain, (k + w * q) / (n + w) AS q FROM domains JOIN sm USING (suffix), kappa WHERE l = 'd'),
hm AS (SELECT host, (k + w * q) / (n + w) AS q, n + w AS size FROM hosts JOIN dm USING (domain), kappa WHERE l = 'h')
SELECT p.page_id, p.host, p.path, fit.rule,
       coalesce(fit.kind, CASE WHEN hm.q - {Z} * sqrt(hm.q * (1 - hm.q) / (size + 1)) > {THRESHOLD}
                               THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit ON p.page_id = fit.page_id AND p.host = fit.host AND p.path = fit.path
LEFT JOIN hm ON p.host = hm.host
"""
