"""URL filters: explicit rules first, else the empirical-Bayes reputation of the host.

Labelled page outcomes are shrunk through beta-binomial priors: a suffix towards
all pages, a registered domain towards its suffix, a host towards its domain. A
page passes when the lower posterior bound of its host reaches a floor. Only
DataFrame functions are used; counts leave each task summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, rule) - fixed values of the query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
FLOOR = 0.5
DEVIATIONS = 2.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return (
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.coalesce(F.regexp_extract(url, pattern, 2), F.lit("")),
    )


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, action).otherwise(verdict)
    return rule, verdict


def _level(groups: DataFrame, parent: Column) -> DataFrame:
    """Posterior mean and weight of each group of one level.

    The within-group correlation comes from the excess of the observed spread over
    the binomial one, and gives the concentration ``1 / rho - 1`` of the prior.
    """
    groups = groups.withColumn("prior", parent)
    apart, noise = F.col("k") / F.col("n") - F.col("prior"), F.col("prior") * (1 - F.col("prior"))
    # Without a group of two outcomes nothing is known of the correlation.
    rho = F.try_divide(F.sum(F.col("n") * apart * apart) - F.sum(noise), F.sum((F.col("n") - 1) * noise))
    fit = groups.where("n > 0").agg(
        F.least(F.lit(0.999), F.greatest(F.lit(0.001), F.coalesce(rho, F.lit(0.5)))).alias("rho")
    )
    # One row, whatever the input: the only table that every group meets.
    groups = groups.join(F.broadcast(fit))
    strength = 1 / F.col("rho") - 1
    return groups.withColumn("weight", F.col("n") + strength).withColumn(
        "mean", (F.col("k") + strength * F.col("prior")) / F.col("weight")
    )


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``(host, n, k, mean, bound)`` for every host of ``pages(page_id, host)``.

    ``outcomes(page_id, good)`` are labels, 1 for a good page; null ones are left
    out and a page may have several. Hosts without labels take their domain's
    expectation, and so on up.
    """
    judged = pages.select("page_id", "host").join(
        outcomes.where("page_id is not null and good is not null").groupBy("page_id").agg(
            F.count("*").alias("n"), F.sum("good").alias("k")
        ),
        "page_id",
        "left",
    )
    bare = F.regexp_replace(F.regexp_replace("host", r"^.*@", ""), r":[0-9]*$", "")
    hosts = (
        judged.groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
        .withColumn("domain", F.regexp_extract(bare, r"([^.]*\.)?[^.]*$", 0))
        .withColumn("suffix", F.regexp_extract(bare, r"[^.]*$", 0))
    )
    total = hosts.agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("all_mean"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = _level(suffixes.join(F.broadcast(total)), F.col("all_mean"))
    domains = _level(
        domains.join(suffixes.select("suffix", F.col("mean").alias("above")), "suffix"), F.col("above")
    )
    hosts = _level(hosts.join(domains.select("domain", F.col("mean").alias("above")), "domain"), F.col("above"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return hosts.select("host", "n", "k", "mean", (F.col("mean") - DEVIATIONS * deviation).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, floor: float = FLOOR) -> DataFrame:
    """``(page_id, host, path, rule, verdict, bound)`` for each row of pages.

    A null url, or one without ``://``, has an empty host, which is a host like
    others. Repeated rows are judged alike; without labels every mean is a half
    and nothing but a rule allows a page. No pages give no rows.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = host_reputation(parsed, outcomes).select("host", F.round("bound", 6).alias("bound"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= floor, "allow").otherwise("block")
    # A host with a third of all pages is a hot key of a plain join, which Spark splits.
    return parsed.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bound"
    )


_LEVEL_SQL = """
{name}_fit as (
    select least(0.999e0, greatest(0.001e0, coalesce(
        (sum(n * (k / n - prior) * (k / n - prior)) - sum(prior * (1 - prior))) / nullif(sum((n - 1) * prior * (1 - prior)), 0),
        0.5e0))) as rho
    from {name}_in where n > 0),
{name}_level as (
    select i.*, (k + (1 / rho - 1) * prior) / (n + (1 / rho - 1)) as mean, n + (1 / rho - 1) as weight
    from {name}_in i, {name}_fit)"""

ORACLE = (
    r"""
with parsed as (
    select page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
    from pages),
outcomes as (
    select doc_id as page_id, count(*) as n, sum(case when quality = 1 and toxic = 0 then 1 else 0 end) as k
    from labels where doc_id is not null and quality is not null and toxic is not null group by doc_id),
hosts as (
    select host, cast(coalesce(sum(n), 0) as double) as n, cast(coalesce(sum(k), 0) as double) as k,
        regexp_extract(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '([^.]*\.)?[^.]*$', 0) as domain,
        regexp_extract(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[^.]*$', 0) as suffix
    from parsed left join outcomes using (page_id) group by host),
total as (select (sum(k) + 1) / (sum(n) + 2) as all_mean from hosts),
domains as (select domain, suffix, sum(n) as n, sum(k) as k from hosts group by domain, suffix),
suffix_in as (select suffix, sum(n) as n, sum(k) as k, any_value(all_mean) as prior from domains, total group by suffix),"""
    + _LEVEL_SQL.format(name="suffix")
    + """,
domain_in as (select d.*, s.mean as prior from domains d join suffix_level s using (suffix)),"""
    + _LEVEL_SQL.format(name="domain")
    + """,
host_in as (select h.host, h.n, h.k, d.mean as prior from hosts h join domain_level d using (domain)),"""
    + _LEVEL_SQL.format(name="host")
    + """,
known as (select host, round(mean - 2 * sqrt(mean * (1 - mean) / (weight + 1)), 6) as bound from host_level),
ruled as (
    select parsed.*, bound, case
        when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
        when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
        when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
        when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
        when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/'
    end as rule
    from parsed left join known using (host))
select page_id, host, path, rule, bound, case
    when rule in ('org/', 'com/fr/') then 'allow'
    when rule is not null then 'block'
    when bound >= 0.5 then 'allow' else 'block' end as verdict
from ruled"""
)
