"""URL filtering by rules, then by empirical-Bayes host reputation, with DataFrame operations only.

Labelled page outcomes (bad or not) are counted per host, then per registered domain and suffix. Each
level's rate is a beta-binomial posterior mean whose prior is the level above: suffixes shrink to the
overall rate, domains to their suffix, hosts to their domain. How strongly is estimated from the data:
the method of moments gives the correlation of outcomes inside a unit of the level, and so the number of
pseudo-outcomes of the prior. A host's pages are blocked if the lower bound of the posterior of its rate
of bad pages exceeds ``max_bad``; a host without outcomes has its domain's rate as its own.

Outcomes are pre-aggregated by host before anything else, so a host with a third of all pages is a row
per task. The table of hosts is joined back by broadcast if it is small, else by a shuffle join.

Defined results: a null url or one without '://' has empty host and path, no rule, and the reputation of
the empty host; a null label is no outcome; an id labelled several times counts once, with its mean;
repeated pages are judged each; without any outcome nothing is blocked; an empty table gives an empty
table; only the id and the url of a page are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import small_or, stored

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Suffixes of more than one label that the registered domain takes one label beyond (a parameter).
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")
MAX_BAD = 0.5
#: Standard normal quantile of the posterior bound.
Z = 1.645
BROADCAST_HOSTS = 500_000
#: The document number that ends a path, with or without a file extension.
_NUMBER = "/([0-9]+)([.][A-Za-z][A-Za-z0-9]*)?/?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first '://' and the next '/', '?' or '#', A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to '?' or '#'."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, long_suffixes: tuple = LONG_SUFFIXES) -> Column:
    """The public suffix: the last label, or the last two if they are a known long suffix."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, long_suffixes: tuple = LONG_SUFFIXES) -> Column:
    """The registered domain: one label more than the suffix."""
    long = F.substring_index(host, ".", -2).isin(*long_suffixes)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _rule_columns(host: Column, path: Column, rules: tuple) -> tuple[Column, Column]:
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in ordered]
    none = F.lit(None).cast("string")
    pick = lambda values: F.coalesce(*[F.when(f, F.lit(v)) for f, v in zip(fits, values, strict=True)], none)
    return pick([h + p for h, p, _ in ordered]), pick([v for *_, v in ordered])


def _concentration(units: DataFrame, by: list[str]) -> float:
    """Pseudo-outcomes of the prior of ``units`` (n, bad), which are nested in ``by``: from the moment
    estimate of the correlation of outcomes within a unit, pooled over the groups."""
    group = units.groupBy(*by) if by else units.groupBy(F.lit(1).alias("all"))
    sums = group.agg(F.sum("n").alias("big"), F.sum("bad").alias("b"), F.sum(F.col("n") * F.col("n")).alias("sq"),
                     F.count(F.lit(1)).alias("k"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("r"))
    sums = sums.filter("k > 1").select(
        (F.col("r") - F.col("b") * F.col("b") / F.col("big")).alias("between"), (F.col("b") - F.col("r")).alias("within"),
        (F.col("k") - 1).alias("df"), (F.col("big") - F.col("k")).alias("dw"), (F.col("big") - F.col("sq") / F.col("big")).alias("eff"))
    s = sums.agg(*[F.sum(c).alias(c) for c in ("between", "within", "df", "dw", "eff")]).first()
    if not s["df"] or not s["dw"] or s["dw"] <= 0:
        return 10.0
    msb, msw, n0 = s["between"] / s["df"], s["within"] / s["dw"], s["eff"] / s["df"]
    rho = (msb - msw) / (msb + (n0 - 1) * msw) if msb + (n0 - 1) * msw > 0 else 0.0
    rho = min(max(rho, 1e-4), 0.9)
    return 1 / rho - 1


def host_reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, n, bad, rate, low) for every host of ``hosts``; ``outcomes``: (host, bad between 0 and 1)."""
    counts = outcomes.groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").alias("bad"))
    known = hosts.select("host").distinct().join(counts, "host", "left").na.fill(0.0, ["n", "bad"])
    known = known.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    known = stored(known, "reputation-hosts")
    total = known.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0.0) + 0.5) / ((total["n"] or 0.0) + 1)
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = known.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    seen = lambda units: units.filter("n > 0")
    k_suffix, k_domain = _concentration(seen(suffixes), []), _concentration(seen(domains), ["suffix"])
    k_host = _concentration(seen(known), ["suffix", "domain"])
    mean = lambda k, prior: (F.col("bad") + k * prior) / (F.col("n") + k)
    suffixes = stored(suffixes.select("suffix", mean(k_suffix, F.lit(overall)).alias("suffix_rate")), "reputation-suffixes")
    domains = domains.join(suffixes, "suffix")
    domains = stored(domains.select("suffix", "domain", mean(k_domain, F.col("suffix_rate")).alias("domain_rate")), "reputation-domains")
    known = known.join(domains, ["suffix", "domain"])
    a = F.col("bad") + k_host * F.col("domain_rate")
    b = F.col("n") - F.col("bad") + k_host * (1 - F.col("domain_rate"))
    known = known.withColumn("rate", a / (a + b)).withColumn("low", F.col("rate") - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))
    return known.select("host", "n", "bad", "rate", "low")


def judged(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES,
           max_bad: float = MAX_BAD) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, rate and low (its host's posterior mean and bound of bad
    pages). ``outcomes``: (url, bad)."""
    url = pages[url_col].cast("string")
    rows = pages.select(pages[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    seen = outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("double").alias("bad")).filter("bad is not null")
    hosts = rows.select("host").unionByName(seen.select("host"))
    reputation = stored(host_reputation(seen, hosts), "reputation")
    _, reputation = small_or(reputation, BROADCAST_HOSTS)
    rule, verdict = _rule_columns(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("low") > max_bad, "block").otherwise("allow")
    out = rows.join(reputation, "host", "left").withColumn("rule", rule)
    return out.select("page_id", "host", "path", "rule", F.coalesce(verdict, by_host).alias("verdict"), "rate", "low")


def page_outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url", doc_col: str = "doc_id",
                  quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(url, bad) of the pages whose document is labelled; a page names its document by the number that
    ends its path, with or without a file extension ('/7', '/7/', '/7.html'). Bad: low quality or toxic."""
    bad = F.when((F.col(quality_col) == 0) | (F.col(toxic_col) == 1), 1.0).when(F.col(quality_col).isNotNull() | F.col(toxic_col).isNotNull(), 0.0)
    by_doc = labels.filter(F.col(doc_col).isNotNull()).groupBy(F.col(doc_col).cast("long").alias("__doc")).agg(F.avg(bad).alias("bad"))
    url = pages.select(pages[url_col].cast("string").alias("url")).withColumn("path", path_of(F.col("url")))
    rows = url.select("url", F.expr(f"try_cast(nullif(regexp_extract(path, '{_NUMBER}', 1), '') AS BIGINT)").alias("__doc"))
    return rows.filter("__doc is not null").join(by_doc, "__doc").select("url", "bad")


def _oracle() -> str:
    """DuckDB twin of ``op7_url_reputation``."""
    def rho(units: str, by: str) -> str:
        return f"""SELECT CASE WHEN coalesce(sum(k - 1), 0) = 0 OR coalesce(sum(big - k), 0) <= 0 THEN 10e0 ELSE
            1 / least(greatest((sum(r - b * b / big) / sum(k - 1) - sum(b - r) / sum(big - k))
              / (sum(r - b * b / big) / sum(k - 1) + (sum(big - sq / big) / sum(k - 1) - 1) * sum(b - r) / sum(big - k)), 1e-4), 0.9) - 1 END AS kappa
          FROM (SELECT sum(n) AS big, sum(bad) AS b, sum(n * n) AS sq, count(*) AS k, sum(bad * bad / n) AS r
                FROM {units} WHERE n > 0 GROUP BY {by} HAVING count(*) > 1)"""
    ordered = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for h, p, _ in ordered]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h + p}'" for f, (h, p, _) in zip(fits, ordered, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, ordered, strict=True)) + " END"
    long = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)
    last = lambda k: f"array_to_string(string_split(host, '.')[-{k}:], '.')"
    return f"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT doc_id, avg(CASE WHEN quality = 0 OR toxic = 1 THEN 1e0 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0e0 END) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
o AS (SELECT host, bad FROM p JOIN l ON l.doc_id = TRY_CAST(nullif(regexp_extract(path, '{_NUMBER}', 1), '') AS BIGINT) WHERE bad IS NOT NULL),
c AS (SELECT host, count(*)::DOUBLE AS n, sum(bad) AS bad FROM o GROUP BY host),
h AS (SELECT host, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad,
             CASE WHEN {last(2)} IN ({long}) THEN {last(3)} ELSE {last(2)} END AS domain,
             CASE WHEN {last(2)} IN ({long}) THEN {last(2)} ELSE {last(1)} END AS suffix
      FROM (SELECT DISTINCT host FROM p) LEFT JOIN c USING (host)),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY suffix, domain),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
g AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS rate FROM h),
ks AS ({rho("s", "true")}), kd AS ({rho("d", "suffix")}), kh AS ({rho("h", "suffix, domain")}),
sr AS (SELECT suffix, (bad + kappa * rate) / (n + kappa) AS rate FROM s, ks, g),
dr AS (SELECT suffix, domain, (bad + kappa * sr.rate) / (n + kappa) AS rate FROM d JOIN sr USING (suffix), kd),
hr AS (SELECT host, bad + kappa * dr.rate AS a, n - bad + kappa * (1 - dr.rate) AS b FROM h JOIN dr USING (suffix, domain), kh)
SELECT page_id, host, path, {rule} AS rule,
       coalesce({verdict}, CASE WHEN a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
       round(a / (a + b), 6) AS rate, round(a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 6) AS low
FROM p JOIN hr USING (host)
"""


SQL = _oracle()
