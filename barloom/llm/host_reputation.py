"""URL filter: allow and block rules first, else a reputation of the host.

A host's reputation is the share of bad outcomes among its labelled pages, shrunk by
beta-binomial priors: the public suffix towards all pages, the registered domain towards its
suffix, the host towards its domain. How strongly a level is shrunk is estimated from the spread
of its own rates (method of moments for the intra-class correlation). A host is blocked when the
lower bound of its posterior rate lies above a limit, so few pages never condemn a host.

Pages are only counted and joined: the tables of hosts, domains and suffixes are aggregates.
A URL that is null or has no ``://`` has the empty host and path and shares the reputation of that
empty host. Pages without a label (null) count nowhere; with no labels at all every page is allowed.
Repeated rows count as often as they occur and each keeps its row; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "or.jp", "org.uk"]
#: Fixed values: (verdict, host, path) of the rules the query applies.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Markup that carries no text.
MARKUP = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"
#: A page is a bad outcome with fewer letters, or with a larger share of symbols in its text.
MIN_LETTERS, MAX_SYMBOLS = 50, 0.1
#: The bound lies so many posterior deviations below the mean; hosts above the rate are blocked.
DEVIATIONS, MAX_BAD = 2.0, 0.5
#: Bounds of the correlation within a level: a prior weighs between 4 and about 10,000 pages.
LEAST_RHO, MOST_RHO = 1e-4, 0.2


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    name = F.regexp_replace(host, r":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column) -> Column:
    name = F.regexp_replace(host, r":[0-9]*$", "")
    labels = F.when(F.substring_index(name, ".", -2).isin(TWO_LABEL_SUFFIXES), 3).otherwise(2)
    cut = F.when(labels == 3, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return F.when(name.rlike(r"^[0-9.]+$"), name).otherwise(cut)


def bad_page(html: Column) -> Column:
    """The labelled outcome of a page by its own text: 1 bad, 0 good, null without html."""
    # each step is named once, so that Spark evaluates it once; symbols are sought in what is no letter
    rest = lambda text: F.struct(F.length(text).alias("n"), F.regexp_replace(text, r"\p{L}+", "").alias("text"))
    sizes = lambda r: F.struct(
        (r["n"] - F.length(r["text"])).alias("letters"),
        F.length(F.regexp_replace(r["text"], r"[\p{M}\p{N}\s.,;:!?'\"()-]+", "")).alias("symbols"),
    )
    bad = lambda c: (c["letters"] < MIN_LETTERS) | (c["symbols"] > MAX_SYMBOLS * (c["letters"] + c["symbols"]))
    found = F.array(F.regexp_replace(html, MARKUP, " "))
    for step in (rest, sizes, bad):
        found = F.transform(found, step)
    return F.when(html.isNotNull(), F.get(found, F.lit(0)).cast("long"))


def correlation(level: DataFrame, parents: list[str], n: str = "n", bad: str = "bad") -> float:
    """Intra-class correlation of the groups in ``level`` about the rates of their parents.

    One row comes to the driver. Where nothing can be estimated the groups count as alike (0).
    """
    sums = level.groupBy(*parents).agg(
        F.sum(n).alias("N"),
        F.sum(bad).alias("B"),
        F.count("*").alias("G"),
        F.sum(F.col(n) * F.col(n)).alias("N2"),
        F.sum(F.pow(F.col(bad).cast("double"), F.lit(2)) / F.col(n)).alias("Q"),
    )
    p = F.col("B") / F.col("N")
    spread = F.col("Q") - F.col("N") * p * p
    noise = p * (1 - p)
    row = sums.agg(
        F.sum(spread - noise * (F.col("G") - 1)).alias("between"),
        F.sum(noise * (F.col("N") - F.col("N2") / F.col("N") - (F.col("G") - 1))).alias("scale"),
    ).first()
    if not row or not row["scale"] or row["scale"] <= 0:
        return 0.0
    return min(max(row["between"] / row["scale"], 0.0), 1.0)


def prior_weight(rho: float) -> float:
    """Pages that the prior of a level counts for."""
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def shrunk(prior: Column, rho: float) -> Column:
    """Posterior mean of a group under a prior mean whose weight follows from ``rho``."""
    weight = F.lit(prior_weight(rho))
    return (F.col("bad") + weight * prior) / (F.col("n") + weight)


def reputation(outcomes: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """From (host, bad 0/1) rows to host, n, bad, mean and lower bound of the posterior rate."""
    # a filter on the outcome would evaluate it a second time
    counts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad")).where("n > 0")
    hosts = stored(
        counts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "host-counts"
    )
    total = lambda *keys: hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains, suffixes = total("suffix", "domain"), total("suffix")
    rho = [correlation(suffixes, []), correlation(domains, ["suffix"]), correlation(hosts, ["suffix", "domain"])]
    whole = total().first()
    base = (whole["bad"] or 0) / whole["n"] if whole and whole["n"] else 0.0
    suffix_rate = suffixes.select("suffix", shrunk(F.lit(base), rho[0]).alias("suffix_rate"))
    domain_rate = domains.join(suffix_rate, "suffix").select("suffix", "domain", shrunk(F.col("suffix_rate"), rho[1]).alias("domain_rate"))
    size = F.col("n") + F.lit(prior_weight(rho[2]))
    posterior = hosts.join(domain_rate, ["suffix", "domain"]).withColumn("mean", shrunk(F.col("domain_rate"), rho[2]))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
    return posterior.select("host", "n", "bad", "mean", (F.col("mean") - F.lit(deviations) * deviation).alias("lower"))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null. For lists of up to some hundred rules."""
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    made = lambda v, h, p: F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    if not longest:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    (v, h, p), rest = longest[0], longest[1:]
    return reduce(lambda when, r: when.when(fits(*r[1:]), made(*r)), rest, F.when(fits(h, p), made(v, h, p)))


def judge(pages: DataFrame, outcome: Column, rules: list[tuple[str, str, str]] = RULES, url: str = "url", keys: tuple[str, ...] = ("page_id",), max_bad: float = MAX_BAD) -> DataFrame:
    """``keys``, host, path, rule and verdict of every page, with the host's figures."""
    hosted = pages.withColumn("host", host_of(F.col(url)))
    seen = reputation(hosted.select("host", outcome.alias("bad"))).select("host", "lower", F.col("mean").alias("bad_rate"))
    split = hosted.select(*keys, "host", path_of(F.col(url)).alias("path"))
    found = split.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).join(seen, "host", "left")
    by_method = F.when(F.col("lower") > max_bad, "block").otherwise("allow")
    return found.select(
        *keys, "host", "path", F.col("hit.rule").alias("rule"), F.coalesce(F.col("hit.verdict"), by_method).alias("verdict")
    )


ORACLE = rf"""
WITH split AS (
  SELECT page_id, html,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)://([^/?#]*)', 1), '{UPPER}', '{LOWER}') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), plain AS (
  SELECT host, regexp_replace(html, '{MARKUP.replace("'", "''")}', ' ', 'g') AS text FROM split WHERE html IS NOT NULL
), sized AS (
  SELECT host, length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters,
    length(regexp_replace(text, '[\p{{L}}\p{{M}}\p{{N}}\s.,;:!?''"()-]+', '', 'g')) AS symbols FROM plain
), counted AS (
  SELECT host, count(*)::DOUBLE AS n,
    sum(CASE WHEN letters < {MIN_LETTERS} OR symbols > {MAX_SYMBOLS} * (letters + symbols) THEN 1 ELSE 0 END)::DOUBLE AS bad
  FROM sized GROUP BY host
), named AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM counted
), labelled AS (
  SELECT *, string_split(name, '.') AS parts,
    list_contains([{", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)}], array_to_string(string_split(name, '.')[-2:], '.')) AS two FROM named
), hosts AS (
  SELECT host, n, bad,
    CASE WHEN two THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix,
    CASE WHEN regexp_full_match(name, '[0-9.]+') THEN name WHEN two THEN array_to_string(parts[-3:], '.') ELSE array_to_string(parts[-2:], '.') END AS domain
  FROM labelled
), domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain
), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix
), groups AS (
  SELECT 1 AS level, '' AS parent, n, bad FROM suffixes UNION ALL SELECT 2, suffix, n, bad FROM domains
  UNION ALL SELECT 3, suffix || ' ' || domain, n, bad FROM hosts
), parents AS (
  SELECT level, sum(n) AS n_all, sum(bad) / sum(n) AS p, count(*) AS g, sum(n * n) AS n2, sum(bad * bad / n) AS q FROM groups GROUP BY level, parent
), spread AS (
  SELECT level, sum(q - n_all * p * p - p * (1 - p) * (g - 1)) AS a, sum(p * (1 - p) * (n_all - n2 / n_all - (g - 1))) AS b FROM parents GROUP BY level
), weights AS (SELECT level, 1 / least(greatest(CASE WHEN b > 0 THEN a / b ELSE 0 END, {LEAST_RHO}), {MOST_RHO}) - 1 AS w FROM spread
), base AS (SELECT sum(bad) / sum(n) AS p FROM hosts
), s1 AS (SELECT suffix, (bad + w * p) / (n + w) AS rate FROM suffixes, base, weights WHERE level = 1
), s2 AS (SELECT suffix, domain, (bad + w * rate) / (n + w) AS rate FROM domains JOIN s1 USING (suffix), weights WHERE level = 2
), s3 AS (SELECT host, n + w AS size, (bad + w * rate) / (n + w) AS rate FROM hosts JOIN s2 USING (suffix, domain), weights WHERE level = 3
), bounds AS (SELECT host, rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (size + 1)) AS lower FROM s3
), fits AS (
  SELECT page_id, host, path, CASE {" ".join(
      f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
      for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])))} END AS hit FROM split
)
SELECT page_id, host, path, CASE WHEN hit IS NOT NULL THEN split_part(hit, ' ', 2) END AS rule,
  CASE WHEN hit IS NOT NULL THEN split_part(hit, ' ', 1) WHEN lower > {MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict
FROM fits LEFT JOIN bounds USING (host)
"""
