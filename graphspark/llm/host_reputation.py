"""Operator 5: URL filter by host rules and empirical-Bayes host reputation.

Written rules come first (the longest that fits wins). Other hosts are judged by their labelled pages: the bad
share of a host is shrunk towards its registered domain, that towards its suffix, and that towards all pages,
each by a beta prior whose strength is fitted to the spread between siblings. A host is blocked when even the
lower posterior bound of its bad share is above ``MAX_BAD``.

The registered domain is one label more than the suffix, which has two labels where ``SUFFIXES`` lists them
(``co.uk``). A port, a user name and a last dot don't count in it; an address of digits is its own domain and suffix.

A null url or one without ``://`` has an empty host and path; no rule fits it and it gets the reputation of the
empty host. Pages without a label count for nobody; without any label the prior alone decides (allow).
Repeated pages are judged alike and each counts. Extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphspark.llm.common import sized_broadcast
from graphspark.session import materialize

#: (verdict, host, path) of the written rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: A host is blocked if its bad share is above this with the certainty of ``BOUND_SD`` posterior deviations.
MAX_BAD = 0.5
BOUND_SD = 1.645
#: Prior strength (in pages) where siblings don't tell, and the bounds of the fitted strength.
STRENGTH = 10.0
STRENGTH_RANGE = (2.0, 1_000.0)
#: Prior of the bad share over all pages: one bad page in ten.
ROOT = (1.0, 9.0)

#: Suffixes of two labels under which names are registered (a parameter of the functions below).
SUFFIXES = tuple(f"{kind}.{country}" for country, kinds in (
    ("uk", "ac co gov ltd me net nhs org plc sch"), ("au", "asn com edu gov id net org"), ("nz", "ac co govt net org school"),
    ("jp", "ac ad co ed go gr lg ne or"), ("kr", "ac co go ne or re"), ("cn", "ac com edu gov net org"),
    ("tw", "com edu gov idv net org"), ("hk", "com edu gov net org"), ("sg", "com edu gov net org"),
    ("my", "com edu gov net org"), ("th", "ac co go in or"), ("id", "ac co go or sch web"), ("in", "ac co edu gov net org"),
    ("br", "com edu gov net org"), ("ar", "com edu gob net org"), ("mx", "com edu gob net org"), ("co", "com edu gov net org"),
    ("za", "ac co gov net org"), ("tr", "com edu gov net org"), ("il", "ac co gov net org"), ("ua", "com edu gov net org"),
    ("pl", "com edu gov net org"), ("es", "com gob nom org"), ("pt", "com edu gov org")) for kind in kinds.split())

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


#: What is no part of a host's name: a user name before it, a last dot and a port after it.
_NOT_NAME = "^.*@|[.]?(:[0-9]*)?$"
_ADDRESS = "^[0-9.]+$"


def domain_of(host: Column, suffixes=SUFFIXES) -> Column:
    """Registered domain: the label before the suffix, and the suffix (a shorter host is its own domain)."""
    name = F.regexp_replace(host, _NOT_NAME, "")
    two = F.substring_index(name, ".", -2)
    return (F.when(name.rlike(_ADDRESS), name).when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two))


def suffix_of(host: Column, suffixes=SUFFIXES) -> Column:
    """The last label, or the last two where they are a listed suffix."""
    name = F.regexp_replace(host, _NOT_NAME, "")
    two = F.substring_index(name, ".", -2)
    return (F.when(name.rlike(_ADDRESS), name).when(two.isin(*suffixes), two).otherwise(F.substring_index(name, ".", -1)))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, n, bad: labelled pages of each host. A page shows the document whose number ends its path.

    Labels are made unique first; several labels of a document count as bad if one says so."""
    known = (labels.where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg((F.min("quality") <= 0).cast("long").alias("_bad")))
    seen = (pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("_path"))
            .select("host", F.expr("try_cast(regexp_extract(_path, '/([0-9]+)[^/]*/?$', 1) as bigint)").alias("doc_id")))
    return (seen.join(known, "doc_id").groupBy("host")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_bad").alias("bad")))


def _strength(children: DataFrame, parent: str) -> DataFrame:
    """``parent``, ``_m``: prior strength of the children by moments.

    Between-sibling variance = spread of the shares less what chance adds; strength = p(1-p)/variance - 1."""
    share = F.col("bad") / F.col("n")
    g = children.groupBy(parent).agg(
        F.sum("n").alias("_n"), F.sum("bad").alias("_b"), F.count(F.lit(1)).alias("_k"),
        F.sum(F.col("n") * share * share).alias("_s2"), F.sum(F.col("n") * F.col("n")).alias("_nn"))
    p = F.col("_b") / F.col("_n")
    spread = F.col("_s2") - F.col("_n") * p * p  # sum of n (share - p)^2
    noise = (F.col("_k") - 1) * p * (1 - p)
    scale = F.col("_n") - F.col("_nn") / F.col("_n")
    var = (spread - noise) / scale
    low, high = STRENGTH_RANGE
    m = (F.when((F.col("_k") < 3) | (scale <= 0) | (p <= 0) | (p >= 1), F.lit(STRENGTH))
         .when(var <= 0, F.lit(high)).otherwise(F.least(F.lit(high), F.greatest(F.lit(low), p * (1 - p) / var - 1))))
    return g.select(parent, m.alias("_m"))


def reputation(per_host: DataFrame) -> DataFrame:
    """host, n, bad, a, b, mean, bound: beta posterior of the bad share of each host with labels, and of
    ``domain`` and ``suffix`` rows (host null) for hosts without any.

    Three aggregations over host counts; hot hosts are one row each by then."""
    hosts = materialize(per_host.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    total = hosts.agg(F.sum("n"), F.sum("bad")).first()
    n, bad = (total[0] or 0), (total[1] or 0)
    root = (ROOT[0] + bad) / (sum(ROOT) + n)
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    top = _strength(suffixes.withColumn("_all", F.lit(1)), "_all").first()  # one row, or none without labels
    suffixes = _posterior(suffixes.withColumn("_mean", F.lit(root)).withColumn("_m", F.lit(top["_m"] if top else STRENGTH)))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = _posterior(domains.join(_strength(domains, "suffix"), "suffix")
                         .join(suffixes.select("suffix", F.col("mean").alias("_mean")), "suffix"))
    own = _posterior(hosts.join(_strength(hosts, "domain"), "domain")
                     .join(domains.select("domain", F.col("mean").alias("_mean")), "domain"))
    cols = ["n", "bad", "mean", "bound"]
    rows = [own.select(F.concat(F.lit("h:"), "host").alias("key"), *cols),
            domains.select(F.concat(F.lit("d:"), "domain").alias("key"), *cols),
            suffixes.select(F.concat(F.lit("s:"), "suffix").alias("key"), *cols)]
    return materialize(rows[0].unionByName(rows[1]).unionByName(rows[2]))


def _posterior(rows: DataFrame) -> DataFrame:
    """Beta posterior with prior mean ``_mean`` and strength ``_m``: mean and lower bound of the bad share."""
    a = F.col("_m") * F.col("_mean") + F.col("bad")
    b = F.col("_m") * (1 - F.col("_mean")) + F.col("n") - F.col("bad")
    rows = rows.withColumn("_a", a).withColumn("_b", b)
    mean = F.col("_a") / (F.col("_a") + F.col("_b"))
    sd = F.sqrt(mean * (1 - mean) / (F.col("_a") + F.col("_b") + 1))
    return (rows.withColumn("mean", mean).withColumn("bound", F.greatest(F.lit(0.0), mean - BOUND_SD * sd))
            .drop("_a", "_b", "_m", "_mean"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_mean, bad_bound for every page (one row a row).

    Reputations are joined to the pages by key: host, else domain, else suffix. A side that a count proves
    small is broadcast; otherwise the join shuffles, and hot hosts are split as skewed."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = reputation(outcomes(pages, labels))
    # which key a host is judged by is settled once for each host, not for each page
    hosts = (urls.select("host").distinct()
             .withColumn("_keys", F.array(F.concat(F.lit("h:"), "host"), F.concat(F.lit("d:"), domain_of(F.col("host"))),
                                          F.concat(F.lit("s:"), suffix_of(F.col("host")))))
             .select("host", F.posexplode("_keys").alias("_rank", "key")))
    best = (hosts.join(sized_broadcast(known), "key").groupBy("host")
            .agg(F.min_by(F.struct("mean", "bound"), "_rank").alias("_rep")))
    rows = urls.join(sized_broadcast(materialize(best)), "host", "left").withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("_rep.bound") > MAX_BAD, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                       F.coalesce(F.col("_rule.verdict"), own).alias("verdict"),
                       F.col("_rep.mean").alias("bad_mean"), F.col("_rep.bound").alias("bad_bound"))


def _strength_sql(table: str, parent: str) -> str:
    """The prior strength of :func:`_strength` in SQL."""
    low, high = STRENGTH_RANGE
    return f"""
(SELECT {parent}, CASE WHEN k < 3 OR scale <= 0 OR p <= 0 OR p >= 1 THEN {STRENGTH} WHEN spread - noise <= 0 THEN {high}
                       ELSE least({high}, greatest({low}, p * (1 - p) / ((spread - noise) / scale) - 1)) END AS m
 FROM (SELECT {parent}, k, p, s2 - n * p * p AS spread, (k - 1) * p * (1 - p) AS noise, n - nn / n AS scale
       FROM (SELECT {parent}, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE / sum(n)::DOUBLE AS p, count(*) AS k,
                    sum(n * (bad::DOUBLE / n) * (bad::DOUBLE / n)) AS s2, sum(n * n)::DOUBLE AS nn
             FROM {table} GROUP BY {parent})))"""


def _posterior_sql(keep: str, rows: str) -> str:
    """Mean and bound of :func:`_posterior` in SQL; ``rows`` has n, bad, m and prior."""
    return f"""
(SELECT {keep}, mean, greatest(0.0, mean - {BOUND_SD} * sqrt(mean * (1 - mean) / (m + n + 1))) AS bound
 FROM (SELECT *, (m * prior + bad) / (m + n) AS mean FROM ({rows})))"""


def _name_sql(host: str) -> str:
    return f"regexp_replace({host}, '{_NOT_NAME}', '', 'g')"


def _rules_sql(value, rules=RULES) -> str:
    when = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'"
                    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])))
    return f"CASE {when} END"


def _two_sql(name: str) -> str:
    return f"array_to_string(string_split({name}, '.')[-2:], '.')"


_LISTED = ", ".join(f"'{s}'" for s in SUFFIXES)
ORACLE_SQL = f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
             FROM pages),
urls AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
known AS (SELECT doc_id, CAST(min(quality) <= 0 AS BIGINT) AS bad FROM labels
          WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
names AS (SELECT host, name, {_two_sql('name')} AS two
          FROM (SELECT DISTINCT host, {_name_sql('host')} AS name FROM urls)),
places AS (SELECT host,
                  CASE WHEN regexp_matches(name, '{_ADDRESS}') THEN name
                       WHEN two IN ({_LISTED}) THEN array_to_string(string_split(name, '.')[-3:], '.') ELSE two END AS domain,
                  CASE WHEN regexp_matches(name, '{_ADDRESS}') THEN name
                       WHEN two IN ({_LISTED}) THEN two ELSE string_split(name, '.')[-1] END AS suffix FROM names),
hosts AS (SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, count(*) AS n, sum(bad)::BIGINT AS bad
          FROM (SELECT host, TRY_CAST(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1) AS BIGINT) AS doc_id FROM urls)
          JOIN known USING (doc_id) JOIN places USING (host) GROUP BY host),
total AS (SELECT ({ROOT[0]} + coalesce(sum(bad), 0)) / ({sum(ROOT)} + coalesce(sum(n), 0)) AS root FROM hosts),
suffix_sums AS (SELECT 1 AS everything, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY suffix),
domain_sums AS (SELECT suffix, domain, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY suffix, domain),
suffixes AS {_posterior_sql('suffix', f"SELECT x.*, t.m, total.root AS prior FROM suffix_sums x JOIN {_strength_sql('suffix_sums', 'everything')} t USING (everything), total")},
domains AS {_posterior_sql('domain', f"SELECT x.*, t.m, s.mean AS prior FROM domain_sums x JOIN {_strength_sql('domain_sums', 'suffix')} t USING (suffix) JOIN suffixes s USING (suffix)")},
own AS {_posterior_sql('host', f"SELECT x.*, t.m, d.mean AS prior FROM hosts x JOIN {_strength_sql('hosts', 'domain')} t USING (domain) JOIN domains d USING (domain)")},
judged AS (SELECT p.host, coalesce(o.mean, d.mean, s.mean) AS mean, coalesce(o.bound, d.bound, s.bound) AS bound
           FROM places p LEFT JOIN own o USING (host) LEFT JOIN domains d USING (domain) LEFT JOIN suffixes s USING (suffix))
SELECT page_id, host, path, {_rules_sql(lambda v, h, p: h + p)} AS rule,
       coalesce({_rules_sql(lambda v, h, p: v)}, CASE WHEN bound > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
       round(mean, 6) AS bad_mean, round(bound, 6) AS bad_bound
FROM urls JOIN judged USING (host)
"""
