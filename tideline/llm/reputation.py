"""Host reputation by empirical Bayes: labelled outcomes shrunk from host to registered domain to suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path prefix); a rule fits its host and all subdomains, the longest rule wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Suffixes of two labels under which names are registered (fixed values).
TWO_LABEL_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "co.jp", "ne.jp", "or.jp", "com.au", "net.au", "com.br")
#: A host is blocked if its rate of bad pages is above the limit with this many standard deviations to spare.
MAX_BAD, DEVIATIONS = 0.5, 1.645
#: Bounds of the correlation within a group, and so of the strength of a prior.
LEAST_RHO, MOST_RHO = 1e-4, 0.99


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_address(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path; both are empty where the url is null or has no ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^?#]*", 0)
    return pages.withColumns(
        {"host": lower_ascii(F.regexp_extract(rest, r"(?s)^[^/]*", 0)), "path": F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1)}
    )


def with_domain(rows: DataFrame) -> DataFrame:
    """Add suffix and registered domain of the host; a host of one label is both itself."""
    two = F.substring_index("host", ".", -2)
    suffix = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index("host", ".", -1))
    domain = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index("host", ".", -3)).otherwise(two)
    return rows.withColumns({"suffix": suffix, "domain": domain})


def prior_strength(groups: DataFrame) -> float:
    """How many observations a prior counts for, by the method of moments; ``groups`` has n, bad, mean (the prior's).

    Under a beta-binomial the squared excess of bad pages is n m (1 - m) (1 + (n - 1) rho).
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    row = groups.agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("mean"), 2) - F.col("n") * spread).alias("excess"),
        F.sum(F.col("n") * (F.col("n") - 1) * spread).alias("pairs"),
    ).first()
    rho = row["excess"] / row["pairs"] if row["pairs"] else LEAST_RHO
    return 1 / min(MOST_RHO, max(LEAST_RHO, rho)) - 1


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of each host's rate of bad pages from labelled ones (host, bad).

    Level by level - all, suffix, registered domain, host - a group's prior is its parent's posterior mean, with a
    strength fitted to how much the groups of that level differ. Only sums per host are grouped further, so a host
    with a third of all pages is one row from the start. Returns host, n, bad, rate, sd; no labels give no rows.
    """
    return host_posteriors(outcomes)[0]


def host_posteriors(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, float | None, float]:
    """``host_reputation``, and what is known of other hosts: (domain, rate), (suffix, rate), the rate of all pages
    (null without labels) and the strength of a host's prior."""
    hosts = with_domain(outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    parents, keys, levels = None, [], {}
    for key in ("suffix", "domain", "host"):
        groups = hosts.groupBy(*keys, key).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if parents is None:
            groups = groups.withColumn("mean", F.lit((total["bad"] or 0) / total["n"] if total["n"] else 0.0))
        else:
            groups = groups.join(parents.select(*keys, F.col("rate").alias("mean")), keys)
        strength = prior_strength(groups)
        a = F.col("bad") + strength * F.col("mean")
        b = F.col("n") - F.col("bad") + strength * (1 - F.col("mean"))
        parents = groups.withColumns({"rate": a / (a + b), "sd": F.sqrt(a * b / (a + b + 1)) / (a + b)})
        keys, levels[key] = [*keys, key], parents
    overall = total["bad"] / total["n"] if total["n"] else None
    known = [levels["domain"].select("domain", "rate"), levels["suffix"].select("suffix", "rate")]
    return parents.select("host", "n", "bad", "rate", "sd"), *known, overall, strength


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits the columns host and path, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        dotted = F.concat(F.lit("."), F.col("host"))
        fits = dotted.endswith("." + host) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    max_bad: float = MAX_BAD,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """A verdict on every page: a rule's if one fits, else block if its host's posterior lower bound is too bad.

    ``outcomes`` has labelled pages (url, bad boolean; null bad rows are left out). A host without labels has
    its prior: the rate of its registered domain, else of its suffix, else of all labelled pages, with the fitted
    strength. Without any labels, and for a null or malformed url, a page is allowed unless a rule says otherwise:
    nothing is known against it. Repeated rows get a row each, an empty table none, other columns are not read.
    Returns page_id, host, path, rule, verdict, rate (posterior mean, null for a host without labels).
    """
    known = with_address(outcomes.where("bad IS NOT NULL").select(F.col(url_col).alias("url"), "bad")).select("host", "bad")
    own, domains, suffixes, overall, strength = host_posteriors(known)
    reputation = own.select("host", "rate", (F.col("rate") - deviations * F.col("sd") > max_bad).alias("bad"))
    rule, verdict = rule_of(rules)
    rows = with_address(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    rows = with_domain(rows).join(reputation, "host", "left")
    rows = rows.join(domains.withColumnRenamed("rate", "of_domain"), "domain", "left")
    rows = rows.join(suffixes.withColumnRenamed("rate", "of_suffix"), "suffix", "left")
    prior = F.coalesce("of_domain", "of_suffix", F.lit(overall).cast("double"))
    spread = F.sqrt(prior * (1 - prior) / (strength + 1))
    unseen = (F.col("host") != "") & (prior - deviations * spread > max_bad)
    own = F.when(F.coalesce("bad", unseen), "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "rate"
    )


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages: the last number in the path is the id of the document the page shows."""
    number = F.regexp_extract("path", r"([0-9]{1,18})[^0-9/]*/?$", 1)
    shown = with_address(pages.select("url")).withColumn("doc_id", number.try_cast("long"))
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    return shown.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("url", "bad")


def _level(key: str, before: str, parent: str) -> str:
    return f"""{key}_n AS (
  SELECT {key}, any_value(suffix) AS suffix, any_value(domain) AS domain, sum(n) AS n, sum(bad) AS bad
  FROM hosts GROUP BY {key}
), {key}_m AS (SELECT g.*, {before} AS mean FROM {key}_n g {parent}), {key}_k AS (
  SELECT 1 / least({MOST_RHO}, greatest({LEAST_RHO}, coalesce(
    sum(pow(bad - n * mean, 2) - n * mean * (1 - mean)) / nullif(sum(n * (n - 1) * mean * (1 - mean)), 0), {LEAST_RHO}))) - 1 AS k
  FROM {key}_m
), {key}_ab AS (SELECT m.*, bad + k * mean AS a, n - bad + k * (1 - mean) AS b FROM {key}_m m, {key}_k
), {key}_p AS (SELECT *, a / (a + b) AS rate, sqrt(a * b / (a + b + 1)) / (a + b) AS sd FROM {key}_ab)"""


def _rules(column: str) -> str:
    cases = []
    for what, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        value = host + path if column == "rule" else what
        cases.append(f"WHEN ends_with('.' || h.host, '.{host}') AND starts_with(h.path, '{path}') THEN '{value}'")
    return f"CASE {' '.join(cases)} END"


_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
_LAST = lambda n: f"array_to_string(string_split(host, '.')[-{n}:], '.')"
SQL = f"""
WITH r AS (
  SELECT page_id, url, regexp_extract(CASE WHEN instr(coalesce(url, ''), '://') > 0
         THEN substr(url, instr(url, '://') + 3) ELSE '' END, '(?s)^[^?#]*') AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '(?s)^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '(?s)^[^/]*(.*)$', 1) AS path FROM r
), o AS (
  SELECT host, CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END AS bad
  FROM h JOIN labels l ON l.doc_id = try_cast(regexp_extract(path, '([0-9]{{1,18}})[^0-9/]*/?$', 1) AS BIGINT)
), hosts AS (
  SELECT host, count(*) AS n, sum(bad) AS bad,
         CASE WHEN {_LAST(2)} IN ({_TWO}) THEN {_LAST(2)} ELSE {_LAST(1)} END AS suffix,
         CASE WHEN {_LAST(2)} IN ({_TWO}) THEN {_LAST(3)} ELSE {_LAST(2)} END AS domain FROM o GROUP BY host
), {_level("suffix", "(SELECT sum(bad) / sum(n) FROM hosts)", "")},
{_level("domain", "p.rate", "JOIN suffix_p p ON p.suffix = g.suffix")},
{_level("host", "p.rate", "JOIN domain_p p ON p.domain = g.domain")}
SELECT h.page_id, h.host, h.path, {_rules("rule")} AS rule,
       coalesce({_rules("verdict")}, CASE WHEN coalesce(p.rate - {DEVIATIONS} * p.sd > {MAX_BAD}, h.host <> '' AND h.prior - {DEVIATIONS} * h.spread > {MAX_BAD})
                                          THEN 'block' ELSE 'allow' END) AS verdict
FROM (
  SELECT v.*, sqrt(prior * (1 - prior) / (k + 1)) AS spread FROM (
    SELECT v.*, coalesce(d.rate, s.rate, t.rate) AS prior
    FROM (SELECT *, CASE WHEN {_LAST(2)} IN ({_TWO}) THEN {_LAST(2)} ELSE {_LAST(1)} END AS suffix,
                 CASE WHEN {_LAST(2)} IN ({_TWO}) THEN {_LAST(3)} ELSE {_LAST(2)} END AS domain FROM h) v
    LEFT JOIN domain_p d ON d.domain = v.domain LEFT JOIN suffix_p s ON s.suffix = v.suffix, (SELECT sum(bad) / sum(n) AS rate FROM hosts) t
  ) v, host_k
) h LEFT JOIN host_p p ON p.host = h.host
"""
