"""Host reputation by empirical Bayes, in DataFrame functions only.

Labelled outcomes are counted per host. The share of good pages is shrunk from
the suffix to the registered domain to the host: each level's posterior mean is
the prior mean of the next, and how strongly it pulls follows from how much the
groups of that level differ (beta-binomial moments). A host is blocked where even
the upper posterior bound of its share is low.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf

#: Standard deviations from the posterior mean to the bound, and the least share of good pages.
DEVIATIONS = 1.645
LEAST_SHARE = 0.5
#: Limits of the correlation of pages in one group, which sets the strength of the prior.
CORRELATION = (0.001, 0.999)

# --- fixed values: public suffixes of two labels, where no other list is given -------
PUBLIC_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
    "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
)
# --------------------------------------------------------------------------------------

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _name(host: Column) -> Column:
    """The host without its port."""
    return F.regexp_replace(host, ":[0-9]*$", "")


def suffix_of(host: Column, suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> Column:
    """The last two labels where these are a listed public suffix, else the last."""
    two = F.substring_index(_name(host), ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(two, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> Column:
    """Registered domain: the public suffix and the label before it."""
    name = _name(host)
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``rule`` and ``action`` of the longest rule that fits, else null.

    Rules are ``(action, host/path)``; a rule fits its host and all subdomains where
    the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit(slash + start)
        )
        mine = F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))
        found = F.when(fits, mine).otherwise(found)
    return found


def _strength(groups: DataFrame, mean: str) -> float:
    """Pages that the prior of a level is worth, from rows ``n, good`` around ``mean``."""
    n, rate, m = F.col("n"), F.col("good") / F.col("n"), F.col(mean)
    row = (
        groups.where("n > 0")
        .agg(
            F.sum(n * (rate - m) * (rate - m)).alias("spread"),
            F.sum(n * m * (1 - m)).alias("binomial"),
            F.sum(n).alias("pages"),
            F.sum((n * n).cast("double")).alias("squares"),
            F.count(F.lit(1)).alias("groups"),
        )
        .collect()[0]
    )
    low, high = CORRELATION
    rho = high
    if row["pages"] and row["binomial"]:
        chance = row["binomial"] / row["pages"]
        freedom = row["pages"] - row["squares"] / row["pages"] - (row["groups"] - 1)
        if freedom > 0:
            rho = (row["spread"] - chance * (row["groups"] - 1)) / (chance * freedom)
    rho = min(max(rho, low), high)
    return 1 / rho - 1


def host_reputation(
    outcomes: DataFrame, shelf: Shelf, suffixes: Sequence[str] = PUBLIC_SUFFIXES
) -> DataFrame:
    """``host, n, good, mean, upper`` from rows ``host, good`` (1, 0 or null).

    Hosts whose outcomes are all null are listed too, with the prior of their
    domain. Three numbers per level reach the driver.
    """
    hosts = shelf.put(
        outcomes.groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
        .select(
            "host", domain_of(F.col("host"), suffixes).alias("domain"),
            suffix_of(F.col("host"), suffixes).alias("suffix"), "n", "good",
        )
    )
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = shelf.put(hosts.groupBy("suffix", "domain").agg(*sums))
    by_suffix = shelf.put(domains.groupBy("suffix").agg(*sums))
    row = by_suffix.agg(*sums).collect()[0]
    overall = ((row["good"] or 0) + 1) / ((row["n"] or 0) + 2)

    def shrunk(groups: DataFrame, above: str, name: str) -> DataFrame:
        """Each group's mean after its own pages, around the mean ``above``.

        The prior is worth no more pages than two above those it was seen in.
        """
        s = F.least(F.lit(_strength(groups, above)), F.col("above_n") + F.lit(2.0))
        groups = groups.withColumn("strength", s)
        mean = (F.col("good") + F.col("strength") * F.col(above)) / (
            F.col("n") + F.col("strength")
        )
        return groups.withColumn(name, mean)

    by_suffix = by_suffix.withColumns({"whole": F.lit(overall), "above_n": F.lit(row["n"] or 0)})
    by_suffix = shrunk(by_suffix, "whole", "suffix_mean").select(
        "suffix", "suffix_mean", F.col("n").alias("above_n")
    )
    domains = shrunk(domains.join(shelf.put(by_suffix), "suffix"), "suffix_mean", "domain_mean")
    domains = shelf.put(domains.select("domain", "domain_mean", F.col("n").alias("above_n")))
    hosts = shrunk(hosts.join(domains, "domain"), "domain_mean", "mean")
    total = F.col("n") + F.col("strength")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return shelf.put(
        hosts.select(
            "host", "n", "good", "mean",
            (F.col("mean") + F.lit(DEVIATIONS) * deviation).alias("upper"),
        )
    )


def judge_pages(
    pages: DataFrame, rules: Sequence[tuple[str, str]], *, id_col: str = "page_id",
    url_col: str = "url", good_col: str | None = None,
    suffixes: Sequence[str] = PUBLIC_SUFFIXES,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, upper``.

    A rule decides where one fits, else the reputation of the host. Labelled
    outcomes are ``good_col`` (1 good, 0 bad, null unknown) or, without it, the
    decisions of the rules. Hosts without outcomes lean on their domain, suffix
    and the whole; ``suffixes`` lists the public suffixes of two labels, and a port belongs
    to the host alone. Null urls and urls without ``://`` have the empty host; repeated
    rows keep a row each; other columns are not read.
    """
    url = F.col(url_col).cast("string")
    read = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        (F.col(good_col) if good_col else F.lit(None)).cast("int").alias("outcome"),
    )
    judged = read.withColumn("r", matching_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "r.rule", "r.action", "outcome"
    )
    ruled = F.when(F.col("action") == "allow", 1).when(F.col("action") == "block", 0)
    good = F.col("outcome") if good_col else ruled
    known = host_reputation(
        judged.select("host", good.alias("good")), Shelf(pages.sparkSession), suffixes
    )
    own = F.when(F.col("upper") < LEAST_SHARE, "block").otherwise("allow")
    return judged.join(known.select("host", "upper"), "host").select(
        "page_id", "host", "path", "rule", F.coalesce("action", own).alias("verdict"), "upper"
    )
