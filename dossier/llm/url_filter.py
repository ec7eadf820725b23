"""Reputation of hosts from labelled pages, shrunk from host to domain to suffix."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm.tables import ascii_lower, table

#: (verdict, host, path)
Rule = tuple[str, str, str]
#: The rules of the registered query.
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = ("co.jp", "co.uk", "com.au", "com.br", "com.cn", "org.uk")
#: A host is blocked when its share of bad pages is above MAX_BAD with this many standard
#: deviations to spare.
MAX_BAD, DEVIATIONS = 0.5, 1.645
#: The range in which a level's prior may weigh, in pages.
WEIGHTS = (1.0, 1000.0)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*TWO_LABEL_SUFFIXES), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label more."""
    return F.when(F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES),
                  F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], give) -> Column:
    """``give(rule)`` of the longest rule that fits, else null; of equally long ones the first."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith(f".{rule[1]}")) & path.startswith(rule[2])
        out = F.when(fits, F.lit(give(rule))).otherwise(out)
    return out


def _sums(groups: DataFrame) -> list[Column]:
    """Of the groups of a level that have labelled pages, what a prior's weight is made of."""
    share = F.col("bad") * F.col("bad") / F.col("n")
    return groups.filter("n > 0").agg(
        F.count("*").alias("groups"), F.sum("n").cast("double").alias("pages"), F.sum("bad").alias("bad"),
        F.sum(share).alias("between"), F.sum(F.col("bad") - share).alias("within"),
        F.sum(F.col("squares") / F.col("n")).alias("squares")).first()


def prior_weight(level, above) -> float:
    """How many pages the mean of the level above is worth to the groups of a level.

    The analysis-of-variance estimate of the correlation inside the groups, r, gives a beta prior
    of weight 1 / r - 1; where it cannot be estimated, the prior weighs most.
    """
    groups = level["groups"] - above["groups"]
    if groups <= 0 or level["pages"] <= level["groups"]:
        return WEIGHTS[1]
    between = (level["between"] - above["between"]) / groups
    within = level["within"] / (level["pages"] - level["groups"])
    spread = between + ((level["pages"] - above["squares"]) / groups - 1) * within
    r = (between - within) / spread if spread > 0 else 0.0
    return max(WEIGHTS[0], min(WEIGHTS[1], 1 / r - 1)) if r > 0 else WEIGHTS[1]


def host_reputation(hosts: DataFrame) -> DataFrame:
    """Posterior of the share of bad pages per host.

    ``hosts`` has one row per ``host`` with ``n`` labelled and ``bad`` bad pages.  Each level's
    share is a beta-binomial posterior whose prior mean is the posterior of the level above:
    all pages, suffix, registered domain, host.  A level's weight is estimated from its groups
    inside the groups of the level above.  Returns ``host, n, bad, mean, low``; ``low`` is the
    bound that filters.  Without any labelled page, means and bounds are null.
    """
    hosts = hosts.select("host", "n", "bad", domain_of(F.col("host")).alias("domain"),
                         suffix_of(F.col("host")).alias("suffix"), (F.col("n") * F.col("n")).alias("squares"))
    up = [F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") * F.col("n")).alias("squares")]
    domains = hosts.groupBy("domain", "suffix").agg(*up)
    suffixes = domains.groupBy("suffix").agg(*up)
    levels = [_sums(x) for x in (suffixes.agg(*up), suffixes, domains, hosts)]  # a row of numbers each
    w_suffix, w_domain, w_host = (prior_weight(b, a) for a, b in zip(levels, levels[1:]))
    mean = levels[0]["bad"] / levels[0]["pages"] if levels[0]["pages"] else None

    def shrunk(weight: float, prior: Column) -> Column:
        return (F.col("bad") + weight * prior) / (F.col("n") + weight)

    suffix_mean = suffixes.select("suffix", shrunk(w_suffix, F.lit(mean).cast("double")).alias("prior"))
    domain_mean = (domains.join(suffix_mean, "suffix")
                   .select("domain", shrunk(w_domain, F.col("prior")).alias("prior")))
    total, mean = F.col("n") + w_host, shrunk(w_host, F.col("prior"))
    return (hosts.join(domain_mean, "domain")
            .select("host", "n", "bad", mean.alias("mean"),
                    (mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (total + 1))).alias("low")))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES,
               max_bad: float = MAX_BAD) -> DataFrame:
    """Allow or block every page by the rules, else by its host's reputation.

    ``outcomes`` holds ``page_id, bad`` (0 or 1; nulls are left out) of labelled pages.  A url
    without ``://`` and a null url have an empty host and path; the empty host has a reputation
    like any other.  Repeated page rows are judged each; an outcome counts once for every row
    of its page.  Returns ``page_id, host, path, rule, verdict, host_pages, host_low``.
    """
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labelled = (outcomes.filter("bad IS NOT NULL").groupBy("page_id")
                .agg(F.max("bad").cast("long").alias("bad")))
    hosts = (parts.select("page_id", "host").join(labelled, "page_id", "left").groupBy("host")
             .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    low = host_reputation(hosts).select("host", F.col("n").alias("host_pages"),
                                        F.round("low", 6).alias("host_low"))
    verdict = matching_rule(F.col("host"), F.col("path"), rules, lambda r: r[0])
    rule = matching_rule(F.col("host"), F.col("path"), rules, lambda r: r[1] + r[2])
    by_host = F.when(F.col("host_low") > max_bad, "block").otherwise("allow")
    return (parts.join(low, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, by_host).alias("verdict"), "host_pages", "host_low"))


def op4_url_filters(spark, sf_dir):
    """Labels of bad quality stand for the outcomes of the pages of the same number."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes)


def _sums_sql(level: str) -> str:
    return f"""s_{level} AS (SELECT count(*) AS k, sum(n)::double AS n, sum(bad * bad / n::double) AS b,
  sum(bad - bad * bad / n::double) AS i, sum(sq / n::double) AS q FROM "{level}" WHERE n > 0)"""


def _weight_sql(level: str, above: str) -> str:
    return f"""w_{level} AS (SELECT CASE WHEN r > 0 THEN least(1000.0, greatest(1.0, 1 / r - 1)) ELSE 1000.0 END AS w
  FROM (SELECT CASE WHEN s > 0 THEN (b - i) / s ELSE 0 END AS r FROM (SELECT *, b + (size - 1) * i AS s FROM (
    SELECT (c.b - p.b) / nullif(c.k - p.k, 0) AS b, c.i / nullif(c.n - c.k, 0) AS i,
      (c.n - p.q) / nullif(c.k - p.k, 0) AS size FROM s_{level} c, s_{above} p))))"""


def _rule_sql(give) -> str:
    cases = "".join(f" WHEN (host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
                    f" THEN '{give(r)}'" for r in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    return f"CASE{cases} END"


_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
_LAST = {k: "array_to_string(list_slice(string_split(host, '.'), -%d, -1), '.')" % k for k in (1, 2, 3)}
SQL = f"""WITH parts AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
lab AS (SELECT doc_id AS page_id, max(1 - quality) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY 1),
host AS (SELECT *, n * n AS sq FROM (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::bigint AS bad,
    CASE WHEN {_LAST[2]} IN ({_TWO}) THEN {_LAST[3]} ELSE {_LAST[2]} END AS domain,
    CASE WHEN {_LAST[2]} IN ({_TWO}) THEN {_LAST[2]} ELSE {_LAST[1]} END AS suffix
  FROM parts LEFT JOIN lab USING (page_id) GROUP BY host)),
domain AS (SELECT domain, suffix, sum(n)::bigint AS n, sum(bad)::bigint AS bad, sum(n * n)::bigint AS sq FROM host GROUP BY 1, 2),
suffix AS (SELECT suffix, sum(n)::bigint AS n, sum(bad)::bigint AS bad, sum(n * n)::bigint AS sq FROM domain GROUP BY 1),
whole AS (SELECT sum(n)::bigint AS n, sum(bad)::bigint AS bad, sum(n * n)::bigint AS sq FROM suffix),
{", ".join(map(_sums_sql, ("whole", "suffix", "domain", "host")))},
{_weight_sql("suffix", "whole")}, {_weight_sql("domain", "suffix")}, {_weight_sql("host", "domain")},
ms AS (SELECT suffix, (s.bad + w * (t.bad / t.n::double)) / (s.n + w) AS prior FROM suffix s, w_suffix, whole t),
md AS (SELECT domain, (d.bad + w * prior) / (d.n + w) AS prior FROM domain d JOIN ms USING (suffix), w_domain),
mh AS (SELECT host, h.n AS n, (h.bad + w * prior) / (h.n + w) AS m, h.n + w AS total
  FROM host h JOIN md USING (domain), w_host),
low AS (SELECT host, n AS host_pages, round(m - {DEVIATIONS} * sqrt(m * (1 - m) / (total + 1)), 6) AS host_low FROM mh)
SELECT page_id, host, path, {_rule_sql(lambda r: r[1] + r[2])} AS rule,
  coalesce({_rule_sql(lambda r: r[0])}, CASE WHEN host_low > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  host_pages, host_low
FROM parts LEFT JOIN low USING (host)"""
