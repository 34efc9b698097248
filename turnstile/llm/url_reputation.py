"""URL filter: rules first, then empirical-Bayes host reputation.

Labelled page outcomes (good = 1, bad = 0) are counted per host. A host's rate is shrunk to its registered
domain, the domain's to its public suffix, the suffix's to the whole, each through a beta-binomial prior
whose strength is estimated from the data (method of moments on the dispersion of the children's rates).
A host is blocked when the upper posterior bound of its good rate lies below ``min_good``: only when the
evidence says that it is bad; hosts without labels take their parents' posterior.

Null urls, and urls without ``://``, have empty host and path, no rule, and the reputation of the empty
host (a host of its own). Labels with null or other outcomes than 0 and 1, and labels of unknown pages, count
for nothing; repeated labels and pages count as often as they stand. Further columns pass unseen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_GOOD = 0.5
Z = 1.645  # one-sided 95 %
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 200.0


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(url, URL, 2)})


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (host + path; ties: as listed) and its verdict, null if none fits. For short
    rule lists: they become one expression."""
    rule = verdict = F.lit(None).cast("string")
    for kind, domain, prefix in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        rule, verdict = F.when(fits, domain + prefix).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _level(child: DataFrame, key: str, parent: DataFrame, up: str) -> DataFrame:
    """Posterior (a, b) of each child row (n, good) under its parent's posterior mean.

    The prior's strength is one figure for the level: rho from the weighted dispersion of the children's
    rates around their parents', strength = 1 / rho - 1, kept within bounds.
    """
    rows = child.join(parent.select(F.col(key).alias(up), (F.col("a") / (F.col("a") + F.col("b"))).alias("p")), up)
    seen = rows.filter("n > 0")
    spread = seen.agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("p"), 2) / (F.col("p") * (1 - F.col("p")))).alias("s"),
        F.count("*").alias("m"),
        F.sum("n").alias("t"),
        F.sum(F.col("n") * F.col("n")).alias("q"),
    )
    rho = (F.col("s") - F.col("m")) / (F.col("t") - F.col("m"))
    strength = F.when((F.col("t") > F.col("m")) & (rho > 0), F.greatest(F.lit(LEAST_STRENGTH), F.least(F.lit(MOST_STRENGTH), 1 / rho - 1))).otherwise(MOST_STRENGTH)
    # One row: the only broadcast here.
    rows = rows.crossJoin(F.broadcast(spread.select(strength.alias("k"))))
    return rows.select(F.col(key), F.col(up), (F.col("k") * F.col("p") + F.col("good")).alias("a"), (F.col("k") * (1 - F.col("p")) + F.col("n") - F.col("good")).alias("b"))


def registered(host: Column) -> Column:
    """The last two labels, without a port; IP addresses and single labels stay whole."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    return F.when(bare.rlike(r"^[0-9.]+$"), bare).otherwise(F.regexp_extract(bare, r"([^.]*\.)?[^.]*$", 0))


def reputation(pages: DataFrame, labels: DataFrame, *, page_id: str = "page_id", label_id: str = "doc_id", outcome: str = "quality", z: float = Z) -> DataFrame:
    """(host, a, b, upper) for every host of ``pages`` (with its ``host`` column)."""
    hosts = pages.select(F.col(page_id).alias("id"), "host")
    known = labels.select(F.col(label_id).alias("id"), F.col(outcome).alias("y")).filter("y in (0, 1)")
    # The labels are first counted by page: a page's rows and its label rows then meet one to one.
    known = known.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("good"))
    counted = hosts.join(known, "id", "left").groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    host = counted.withColumn("domain", registered(F.col("host")))
    host = host.withColumn("suffix", F.regexp_extract("domain", r"[^.]*$", 0)).withColumn("root", F.lit(0))
    tally = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    root = host.groupBy("root").agg(*tally).select("root", (F.col("good") + 1.0).alias("a"), (F.col("n") - F.col("good") + 1.0).alias("b"))
    suffix = _level(host.groupBy("suffix", "root").agg(*tally), "suffix", root.withColumnRenamed("root", "suffix"), "root")
    domain = _level(host.groupBy("domain", "suffix").agg(*tally), "domain", suffix.drop("root").withColumnRenamed("suffix", "domain"), "suffix")
    scored = _level(host, "host", domain.drop("suffix").withColumnRenamed("domain", "host"), "domain")
    a, b = F.col("a"), F.col("b")
    upper = a / (a + b) + z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return scored.select("host", "a", "b", upper.alias("upper"))


def judge(pages: DataFrame, labels: DataFrame, *, rules: Sequence[tuple[str, str, str]] = RULES, min_good: float = MIN_GOOD, page_id: str = "page_id", url_col: str = "url", **kw) -> DataFrame:
    """(page id, host, path, rule, verdict) for each row of ``pages``."""
    parts = with_parts(pages.select(page_id, url_col), url_col)
    known = reputation(parts, labels, page_id=page_id, **kw).select("host", F.when(F.col("upper") < min_good, "block").otherwise("allow").alias("by_host"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return parts.join(known, "host").select(page_id, "host", "path", rule.alias("rule"), F.coalesce(verdict, "by_host").alias("verdict"))


def op10_url_reputation(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def _sql_level(name: str, child: str, key: str, parent: str, parent_key: str, up: str) -> str:
    return f"""{name}_in AS (SELECT c.{key}, c.{up}, c.n, c.good, p.a / (p.a + p.b) AS p FROM {child} c JOIN {parent} p ON c.{up} = p.{parent_key}),
{name}_s AS (SELECT sum(n * pow(good / n - p, 2) / (p * (1 - p))) AS s, count(*) AS m, sum(n) AS t, sum(n * n) AS q FROM {name}_in WHERE n > 0),
{name}_k AS (SELECT CASE WHEN t > m AND (s - m) / (t - m) > 0 THEN greatest({LEAST_STRENGTH}, least({MOST_STRENGTH}, 1 / ((s - m) / (t - m)) - 1)) ELSE {MOST_STRENGTH} END AS k FROM {name}_s),
{name} AS (SELECT {key}, {up}, k * p + good AS a, k * (1 - p) + n - good AS b FROM {name}_in, {name}_k)"""


def _sql_rules(column: str) -> str:
    cases = []
    for kind, domain, prefix in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        value = kind if column == "verdict" else domain + prefix
        cases.append(f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{prefix}') THEN '{value}'")
    return "CASE " + " ".join(cases) + " END"


ORACLE = f"""
WITH parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
known AS (SELECT doc_id, count(*) AS n, sum(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
hosts AS (SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS good FROM parts LEFT JOIN known ON page_id = doc_id GROUP BY host),
bare AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS bare FROM hosts),
host_n AS (SELECT host, n, good, CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN bare ELSE regexp_extract(bare, '([^.]*\\.)?[^.]*$', 0) END AS domain FROM bare),
host_t AS (SELECT *, regexp_extract(domain, '[^.]*$', 0) AS suffix, 0 AS root FROM host_n),
suffix_t AS (SELECT suffix, root, sum(n) AS n, sum(good) AS good FROM host_t GROUP BY suffix, root),
domain_t AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM host_t GROUP BY domain, suffix),
root_p AS (SELECT 0 AS root, coalesce(sum(good), 0) + 1.0 AS a, coalesce(sum(n) - sum(good), 0) + 1.0 AS b FROM host_t),
{_sql_level("suffix_p", "suffix_t", "suffix", "root_p", "root", "root")},
{_sql_level("domain_p", "domain_t", "domain", "suffix_p", "suffix", "suffix")},
{_sql_level("host_p", "host_t", "host", "domain_p", "domain", "domain")},
judged AS (SELECT host, CASE WHEN a / (a + b) + {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) < {MIN_GOOD} THEN 'block' ELSE 'allow' END AS by_host FROM host_p)
SELECT page_id, parts.host, path, {_sql_rules("rule").replace("host", "parts.host")} AS rule, coalesce({_sql_rules("verdict").replace("host", "parts.host")}, by_host) AS verdict
FROM parts JOIN judged ON parts.host = judged.host
"""
