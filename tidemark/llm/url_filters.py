"""URL filters: listed rules first, empirical-Bayes host reputation for the rest.

Labelled outcomes of pages (1 bad, 0 good) are counted per host, without a user
name or port.  A bad rate is shrunk along suffix -> registered domain -> host:
each level's prior is a beta with the parent's posterior mean, and its strength
is estimated from the data by moments (how much the children's rates differ
beyond binomial noise).  A host is blocked when the lower bound of its posterior
bad rate, by the normal approximation (mean minus z standard deviations, those
of its parents included), exceeds ``max_lift`` times the rate of all outcomes,
or ``max_bad_rate`` if that is less.  Hosts without outcomes have their parent's
mean as theirs.

Defined cases: a null url, or one without ``://``, has an empty host and path and
is judged as the host ''; null outcomes are ignored; repeated rows count each
time; without any outcome everything unlisted is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_grouped, materialize, read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.nz", "co.in", "com.mx", "com.ar")


@dataclass(frozen=True)
class Reputation:
    max_bad_rate: float = 0.5
    max_lift: float = 2.0
    z: float = 1.645
    min_strength: float = 1.0
    max_strength: float = 1000.0
    two_label_suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, as written; null if none does."""
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in sorted(rules, key=len, reverse=True):
        name, _, rest = rule.partition("/")
        under = (host == name) | F.endswith(host, F.lit(f".{name}"))
        found = found.when(under & F.startswith(path, F.lit(f"/{rest}")), F.lit(rule))
    return found


def site_of(host: Column) -> Column:
    """The host without a user name and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def suffix_of(host: Column, two_labels: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_labels), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffix: Column) -> Column:
    labels = F.size(F.split(suffix, r"\.")) + 1
    return F.when(labels == 3, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _with_parents(level: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children with their parent's columns; parents of very many children (``com``) go by broadcast."""
    sizes = level.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    return join_grouped(level, parents.join(sizes, key), key, "_size", level.count()).drop("_size")


def _strength(level: DataFrame, child: str, parent: str, p: Reputation) -> DataFrame:
    """One row ``m``: the strength of the beta prior that children of one parent share."""
    within = level.groupBy(parent).agg(
        F.sum("n").alias("_n"), F.sum("bad").alias("_k"), F.sum(F.col("n") * F.col("n")).alias("_nn"), F.count(child).alias("_c")
    )
    rated = _with_parents(level.where("n > 0"), within.where("_n > 0"), parent)
    spread = rated.agg(F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("_k") / F.col("_n"), 2)).alias("s"), F.count(F.lit(1)).alias("children"))
    whole = within.where("_n > 0").agg(
        F.sum("_n").alias("n"), F.sum("_k").alias("k"), F.sum(F.col("_n") - F.col("_nn") / F.col("_n")).alias("free"), F.count(F.lit(1)).alias("parents")
    )
    rate = F.col("k") / F.col("n")
    noise = (F.col("children") - F.col("parents")).cast("double")
    rho = F.try_divide(F.try_divide(F.col("s"), rate * (1 - rate)) - noise, F.col("free") - noise)
    low, high = 1 / (p.max_strength + 1), 1 / (p.min_strength + 1)
    rho = F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(rho, F.lit(low))))
    return spread.join(whole).select((1 / rho - 1).alias("m"))


def reputations(hosts: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """``hosts``: host, pages, n, bad (outcomes and bad ones).  Adds bad_rate, bound and verdict."""
    suffix = suffix_of(F.col("host"), p.two_label_suffixes)
    hosts = hosts.withColumn("suffix", suffix).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    domains = materialize(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("root", F.lit(0))
    root = suffixes.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(0.0)).alias("p_mean"), F.sum("n").alias("_n"))
    root = root.select("p_mean", (F.col("p_mean") * (1 - F.col("p_mean")) / (F.col("_n") + 1)).alias("p_var"))

    def shrunk(level: DataFrame, parents: DataFrame, on: str | None, child: str, parent: str) -> DataFrame:
        """Posterior mean and variance; the parent's own variance counts by the weight of the prior."""
        joined = _with_parents(level, parents, on) if on else level.join(F.broadcast(parents))
        joined = joined.join(F.broadcast(_strength(level, child, parent, p)))
        weight = F.col("m") + F.col("n")
        joined = joined.withColumn("mean", (F.col("m") * F.col("p_mean") + F.col("bad")) / weight)
        own = F.col("mean") * (1 - F.col("mean")) / (weight + 1)
        return joined.withColumn("var", own + F.pow(F.col("m") / weight, 2) * F.col("p_var"))

    def as_parent(level: DataFrame, key: str) -> DataFrame:
        return level.select(key, F.col("mean").alias("p_mean"), F.col("var").alias("p_var"))

    # A level's posteriors are a table of their own, so no plan holds more than one level.
    s = materialize(as_parent(shrunk(suffixes, root, None, "suffix", "root"), "suffix"), "suffixes")
    d = materialize(as_parent(shrunk(domains, s, "suffix", "domain", "suffix"), "domain"), "domain-posteriors")
    h = shrunk(hosts, d, "domain", "host", "domain")
    h = h.withColumn("bound", F.col("mean") - p.z * F.sqrt("var"))
    cut = root.select(F.least(p.max_lift * F.col("p_mean"), F.lit(p.max_bad_rate)).alias("_cut"))
    h = h.join(F.broadcast(cut))
    verdict = F.when(F.col("bound") > F.col("_cut"), "block").otherwise("allow").alias("host_verdict")
    return h.select("host", "pages", "n", "bad", F.col("mean").alias("bad_rate"), "bound", verdict)


def judge(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str] | None = None, p: Reputation = Reputation()) -> DataFrame:
    """``pages``: page_id, url.  ``outcomes``: page_id, bad (1, 0 or null).  One row per page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = materialize(pages.select("page_id", host.alias("host"), path.alias("path"), site_of(host).alias("site")), "urls")
    marked = urls.join(outcomes.where("bad IS NOT NULL").select("page_id", F.col("bad").cast("long")), "page_id")
    rated = marked.groupBy("site").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad"))
    hosts = urls.groupBy("site").agg(F.count(F.lit(1)).alias("pages")).join(rated, "site", "left").fillna(0, ["n", "bad"]).withColumnRenamed("site", "host")
    table = materialize(reputations(materialize(hosts, "hosts"), p), "reputations").withColumnRenamed("host", "site")
    df = join_grouped(urls, table, "site", "pages", urls.count())
    rules = RULES if rules is None else rules
    df = df.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    listed = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule, verdict in rules.items():
        listed = listed.when(F.col("rule") == rule, F.lit(verdict))
    return df.select("page_id", "host", "path", "rule", F.coalesce(listed, F.col("host_verdict")).alias("verdict"), "bad_rate", "bound")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: ``labels.quality`` under the same number as the page (0 is bad)."""
    outcomes = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), outcomes).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(x, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(x, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(url, '') AS x FROM pages) a),
r AS (
  SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS site, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u),
h0 AS (
  SELECT u.site AS host, CAST(count(l.quality) AS DOUBLE) AS n, CAST(coalesce(sum(1 - l.quality), 0) AS DOUBLE) AS bad
  FROM r u LEFT JOIN labels l ON l.doc_id = u.page_id GROUP BY u.site),
h AS (
  SELECT *, list_aggregate(p[greatest(len(p) - 1, 1):], 'string_agg', '.') AS two, p[len(p)] AS one, p FROM (SELECT *, string_split(host, '.') AS p FROM h0) a),
hd AS (
  SELECT host, n, bad,
         CASE WHEN two IN ('co.uk','org.uk','ac.uk','com.au','com.br','co.jp','co.nz','co.in','com.mx','com.ar') THEN two ELSE one END AS suffix,
         CASE WHEN two IN ('co.uk','org.uk','ac.uk','com.au','com.br','co.jp','co.nz','co.in','com.mx','com.ar') AND len(p) > 2
              THEN list_aggregate(p[len(p) - 2:], 'string_agg', '.') ELSE two END AS domain
  FROM h),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hd GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY 1),
root AS (SELECT mean, mean * (1 - mean) / (n + 1) AS var FROM (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0 END AS mean, sum(n) AS n FROM s) a),
lv AS (
  SELECT 's' AS k, suffix AS child, 'root' AS parent, n, bad FROM s
  UNION ALL SELECT 'd', domain, suffix, n, bad FROM d
  UNION ALL SELECT 'h', host, domain, n, bad FROM hd),
w AS (SELECT k, parent, sum(n) AS n, sum(bad) AS bad, sum(n * n) AS nn FROM lv GROUP BY 1, 2 HAVING sum(n) > 0),
sp AS (SELECT lv.k, sum(lv.n * power(lv.bad / lv.n - w.bad / w.n, 2)) AS ss, count(*) AS children
       FROM lv JOIN w ON w.k = lv.k AND w.parent = lv.parent WHERE lv.n > 0 GROUP BY 1),
wh AS (SELECT k, sum(bad) / sum(n) AS rate, sum(n - nn / n) AS free, count(*) AS parents FROM w GROUP BY 1),
rho AS (SELECT wh.k, CASE WHEN rate * (1 - rate) = 0 OR free - (children - parents) = 0 THEN NULL
                          ELSE (ss / (rate * (1 - rate)) - (children - parents)) / (free - (children - parents)) END AS x
        FROM wh JOIN sp ON sp.k = wh.k),
m AS (SELECT k, 1 / greatest(1 / 1001.0, least(0.5, coalesce(x, 1 / 1001.0))) - 1 AS m FROM rho),
sm AS (SELECT suffix, mean, mean * (1 - mean) / (m + n + 1) + power(m / (m + n), 2) * pv AS var
       FROM (SELECT suffix, m, n, var AS pv, (m * mean + bad) / (m + n) AS mean FROM s, root, m WHERE k = 's') a),
dm AS (SELECT domain, mean, mean * (1 - mean) / (m + n + 1) + power(m / (m + n), 2) * pv AS var
       FROM (SELECT domain, m, n, sm.var AS pv, (m * sm.mean + bad) / (m + n) AS mean FROM d JOIN sm ON sm.suffix = d.suffix, m WHERE k = 'd') a),
hm AS (SELECT host, mean, mean * (1 - mean) / (m + n + 1) + power(m / (m + n), 2) * pv AS var
       FROM (SELECT host, m, n, dm.var AS pv, (m * dm.mean + bad) / (m + n) AS mean FROM hd JOIN dm ON dm.domain = hd.domain, m WHERE k = 'h') a),
v AS (SELECT host, CASE WHEN hm.mean - 1.645 * sqrt(hm.var) > least(2 * root.mean, 0.5) THEN 'block' ELSE 'allow' END AS verdict FROM hm, root)
SELECT page_id, r.host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE coalesce(v.verdict, 'allow') END AS verdict
FROM r LEFT JOIN v ON v.host = r.site
"""
