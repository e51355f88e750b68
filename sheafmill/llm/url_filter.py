"""URL filter: explicit rules first, then an empirical-Bayes reputation of the host.

The labelled pages of a host are bad or not. Their rate is shrunk twice through beta-binomial
priors: a registered domain towards its suffix, a host towards its domain; the suffix itself is
shrunk towards the corpus. A prior's mean is the posterior mean one level up; its strength is a
method-of-moments fit over the domains (hosts) of the suffix (domain's suffix). A host is blocked
if a lower posterior bound of its bad rate, mean - z * sd, is above ``max_bad_rate``.

The pages are read once for the counts of each host, which are written down; all else is aggregates
by host, domain and suffix of these, joined back to the pages. Counts are aggregated before any
shuffle, so a hot host costs a row per task.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and
takes the corpus' own reputation; a host without labels takes its domain's, then its suffix's;
without any label everything that no rule blocks is allowed. A repeated page gives a row each
time. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frozen

#: (verdict, rule); a rule is a host, and the beginning of a path.
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
#: Suffixes of more than one label under which domains are registered, if a caller gives no list.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, suffixes: Iterable[str] = SUFFIXES) -> Column:
    labels = F.split(host, r"\.")
    last = lambda n: F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n))
    out = F.element_at(labels, -1)
    by_length: dict[int, list[str]] = {}
    for s in suffixes:
        by_length.setdefault(s.count(".") + 1, []).append(s)
    for n, names in sorted(by_length.items()):
        out = F.when(last(n).isin(*names), last(n)).otherwise(out)
    return out


def domain_of(host: Column, suffixes: Iterable[str] = SUFFIXES) -> Column:
    labels = F.split(host, r"\.")
    depth = F.size(F.split(suffix_of(host, suffixes), r"\.")) + 1
    return F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - depth + 1, F.lit(1)), depth))


def fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits; of equally long ones the first by name; else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        out = F.when(fits(host, path, rule), F.lit(rule)).otherwise(out)
    return out


def _moments(counts: DataFrame, by: str, least: float, most: float) -> DataFrame:
    """Strength of the beta prior over the members of ``by``, from the spread of their rates."""
    rate = F.col("bad") / F.col("n")
    stats = counts.groupBy(by).agg(F.count(F.lit(1)).alias("k"), F.avg(rate).alias("m"), F.var_samp(rate).alias("v"))
    fit = F.col("m") * (1 - F.col("m")) / F.col("v") - 1
    usable = (F.col("k") > 1) & (F.col("v") > 0)
    strength = F.when(usable, F.least(F.greatest(fit, F.lit(least)), F.lit(most))).otherwise(F.lit(most / 10))
    return stats.select(by, strength.alias("strength"))


def host_counts(outcomes: DataFrame, suffixes: Iterable[str] = SUFFIXES) -> DataFrame:
    """Of rows (host, bad), where ``bad`` may be null: each host's labelled and bad ones, domain and suffix, written down."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    return frozen(hosts.withColumns({"domain": domain_of(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes)}), "hosts")


def reputations(counts: DataFrame, least: float = 1.0, most: float = 100.0) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Beta posteriors (a, b) by host, by domain, by suffix and of the corpus, from :func:`host_counts`."""
    hosts = counts.where("n > 0 and host <> ''")
    domains = frozen(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    corpus = domains.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select((F.col("bad") + 0.5).alias("a"), (F.col("n") - F.col("bad") + 0.5).alias("b"))

    def post(counts: DataFrame, *keys: str) -> DataFrame:
        """Prior mean ``m`` and strength ``s`` are columns of ``counts``."""
        return counts.select(*keys, (F.col("s") * F.col("m") + F.col("bad")).alias("a"), (F.col("s") * (1 - F.col("m")) + F.col("n") - F.col("bad")).alias("b"))

    mean = (F.col("a") / (F.col("a") + F.col("b"))).alias("m")
    top = post(suffixes.withColumns({"m": corpus.select(mean).scalar(), "s": F.lit(most / 10)}), "suffix")
    mid = post(domains.join(_moments(domains, "suffix", least, most).withColumnRenamed("strength", "s"), "suffix").join(top.select("suffix", mean), "suffix"), "domain", "suffix")
    low = post(hosts.join(_moments(hosts, "suffix", least, most).withColumnRenamed("strength", "s"), "suffix").join(mid.select("domain", mean), "domain"), "host")
    return low, mid.drop("suffix"), top, corpus


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad_rate: float = 0.25, z: float = 1.645, id_col: str = "page_id", url_col: str = "url", suffixes: Iterable[str] = SUFFIXES) -> DataFrame:
    """A row for each page: id, host, path, rule, verdict, and the posterior bound ``bad_bound``.

    ``outcomes`` has rows (page id, bad 0/1) of labelled pages, the id named as in ``pages``.
    The corpus' posterior is a scalar subquery; the other levels are joined by key and the
    optimiser picks how, by their size.
    """
    slim = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labelled = outcomes.select(F.col(id_col).alias("page_id"), F.col("bad").cast("long").alias("bad")).where("bad is not null")
    hosts = host_counts(slim.join(labelled, "page_id", "left").select("host", "bad"), suffixes)
    low, mid, top, corpus = reputations(hosts)
    pick = lambda x: F.coalesce(F.col(f"h.{x}"), F.col(f"d.{x}"), F.col(f"s.{x}"), corpus.select(x).scalar())
    known = hosts.alias("x").join(low.alias("h"), F.col("x.host") == F.col("h.host"), "left").join(mid.alias("d"), F.col("x.domain") == F.col("d.domain"), "left").join(top.alias("s"), F.col("x.suffix") == F.col("s.suffix"), "left")
    a, b = pick("a"), pick("b")
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    known = frozen(known.select(F.col("x.host").alias("host"), F.greatest(bound, F.lit(0.0)).alias("bad_bound")), "reputations")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    by_rule = F.create_map(*[F.lit(x) for verdict, r in rules for x in (r, verdict)])
    return slim.join(known, "host").withColumn("rule", rule).select(
        "page_id", "host", "path", "rule",
        F.when(F.col("rule").isNotNull(), by_rule[F.col("rule")]).when(F.col("bad_bound") > max_bad_rate, "block").otherwise("allow").alias("verdict"),
        "bad_bound",
    )
