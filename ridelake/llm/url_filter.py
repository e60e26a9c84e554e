"""URL filtering by allow/block rules and empirical-Bayes host reputation.

Labelled page outcomes are counted per host.  Each level of
global -> suffix -> registered domain -> host shrinks its own counts
towards the posterior mean of the level above through a beta prior, whose
strength is estimated from the spread between the groups of that level
(method of moments for the beta-binomial).  A host is blocked when even the
lower bound of its posterior bad share is above the threshold.

All DataFrame/SQL: pages are reduced to their URL, outcomes to one row a
host, and only per-host rows are joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .common import UPPER, prepare, staged, table

#: (verdict, host, path): fixed values of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Second labels that are public below a country code (``co.uk``, ``com.au``),
#: fixed values: names are registered one label further left there.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "ltd", "mil", "net", "nom", "or", "org", "plc", "sch")

URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_case(rules, value) -> str:
    """CASE over the rules, longest first; a rule fits its host and all
    subdomains when the path starts with the rule's."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    whens = " ".join(
        f"WHEN (p.host = {_quoted(h)} OR endswith(p.host, {_quoted('.' + h)}))"
        f" AND startswith(p.path, {_quoted(p)}) THEN {_quoted(value(v, h, p))}"
        for v, h, p in ordered)
    return f"CASE {whens} END" if whens else "CAST(NULL AS STRING)"


def _strength(groups: str) -> str:
    """Prior strength of a level, as a scalar subquery: method of moments for
    groups (n, bad) around the mean ``up`` that each has from the level above.
    One outcome alone says nothing about the spread."""
    return f"""(
      SELECT 1 / least(greatest(coalesce(try_divide(
               sum(n * pow(bad / n - up, 2)) - sum(up * (1 - up)),
               sum((n - 1) * up * (1 - up))), 0.5), 0.0001), 0.99) - 1
      FROM {groups} WHERE n > 1)"""


def host_levels(host: str, second_level) -> str:
    """SQL for the registered domain and public suffix of ``host``."""
    public = rf"(^|\.)({'|'.join(second_level)})\.[a-z][a-z]$" if second_level else "(?!)"
    n = f"CASE WHEN {host} RLIKE r'{public}' THEN 2 ELSE 1 END"
    return (f"substring_index({host}, '.', -1 - {n}) AS domain,"
            f" substring_index({host}, '.', -({n})) AS suffix")


def host_posteriors(parsed: DataFrame, outcomes: DataFrame, z: float,
                    second_level=SECOND_LEVEL) -> DataFrame:
    """(host, n, mean, lower): labelled outcomes of each host, and the mean and
    lower bound of its posterior bad share."""
    spark = parsed.sparkSession
    # one row a host, counted once: every level below reads this table
    hosts = staged(spark.sql("""
      SELECT p.host, sum(coalesce(l.n, 0)) AS n, sum(coalesce(l.bad, 0)) AS bad
      FROM (SELECT page_id, host FROM {parsed}) p LEFT JOIN (
        SELECT page_id, count(*) AS n, sum(bad) AS bad FROM {outcomes}
        WHERE bad IS NOT NULL AND page_id IS NOT NULL GROUP BY page_id) l
      ON p.page_id = l.page_id GROUP BY p.host""", parsed=parsed, outcomes=outcomes), "hosts")
    return spark.sql(f"""
    WITH named AS (
      SELECT host, n, bad, {host_levels('host', second_level)} FROM {{hosts}}),
    total AS (
      SELECT coalesce(try_divide(sum(bad), sum(n)), CAST(0.0 AS DOUBLE)) AS mu FROM named),
    suffix_up AS (
      SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT mu FROM total) AS up
      FROM named GROUP BY suffix),
    suffixes AS (
      SELECT suffix, (bad + m * up) / (n + m) AS mean
      FROM (SELECT *, {_strength('suffix_up')} AS m FROM suffix_up)),
    domain_up AS (
      SELECT d.*, s.mean AS up FROM (
        SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY domain, suffix) d
      JOIN suffixes s ON d.suffix = s.suffix),
    domains AS (
      SELECT domain, (bad + m * up) / (n + m) AS mean
      FROM (SELECT *, {_strength('domain_up')} AS m FROM domain_up)),
    host_up AS (
      SELECT h.host, h.n, h.bad, d.mean AS up FROM named h JOIN domains d ON h.domain = d.domain),
    posterior AS (
      SELECT host, n, (bad + m * up) / (n + m) AS mean, n + m AS weight
      FROM (SELECT *, {_strength('host_up')} AS m FROM host_up))
    SELECT host, n, mean,
           greatest(0, mean - {z} * sqrt(mean * (1 - mean) / (weight + 1))) AS lower
    FROM posterior""", hosts=hosts)


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = 0.5,
               z: float = 1.645, second_level=SECOND_LEVEL) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, and the posterior.

    ``outcomes`` (page_id, bad 0/1) may be empty, have null or repeated rows
    (each counts) or ids of no page.  A null URL, or one without ``://``, has
    an empty host and path and is judged as the host ''.  Pages of unlabelled
    hosts get the prior of their domain or suffix.  Repeated pages are judged
    once each; an empty table gives no rows; extra columns are not read.
    ``rules`` is a short list held in the plan.  The public suffix of a host is
    its last label, or the last two where ``second_level`` holds the first of
    them and the other is a country code; the registered domain has one label
    more.
    """
    spark = pages.sparkSession
    parsed = spark.sql(f"""
      SELECT page_id,
             translate(regexp_extract(u, r'{URL_PATTERN}', 1), '{UPPER}', '{UPPER.lower()}') AS host,
             regexp_extract(u, r'{URL_PATTERN}', 2) AS path
      FROM (SELECT page_id, coalesce(url, '') AS u FROM {{pages}})""", pages=pages)
    return spark.sql(f"""
    SELECT p.page_id, p.host, p.path, {rule_case(rules, lambda v, h, p: h + p)} AS rule,
           coalesce({rule_case(rules, lambda v, h, p: v)},
                    CASE WHEN b.lower > {threshold} THEN 'block' ELSE 'allow' END) AS verdict,
           b.n AS host_labels, round(b.mean, 6) AS bad_mean, round(b.lower, 6) AS bad_lower
    FROM {{parsed}} p JOIN {{bounds}} b USING (host)
    """, parsed=parsed, bounds=host_posteriors(parsed, outcomes, z, second_level))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """A labelled page is bad if it is of low quality or toxic."""
    return labels.selectExpr("doc_id AS page_id",
                             "CASE WHEN quality = 0 OR toxic = 1 THEN 1"
                             " WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END AS bad")


def op7_url_filter(spark, sf_dir):
    """Every page's URL under the contract's rules, else its host's posterior."""
    prepare(spark)
    return judge_urls(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))
