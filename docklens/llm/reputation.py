"""URL filter by rules and by the reputation of hosts, shrunk by empirical Bayes.

A rule names a host and the start of a path; the longest rule that fits an URL decides. Pages
without a rule are judged by their host: of labelled pages, each bad or not, the share of bad
ones is taken as a beta-binomial draw around the share of the host's registered domain, that
one around the share of its public suffix, and that one around the share of all pages. At each
level the strength of the prior (how alike the children of one parent are) comes from the
scatter of the counts by the method of moments, so a host with few labelled pages, or none, is
judged mostly by its domain, and so on upwards. A host is blocked when the lower posterior
bound of its share of bad pages exceeds a limit.

The bound is that of a normal distribution of the log odds, with the variance 1/a + 1/b of a
Beta(a, b) posterior. The public suffix is the last label of the host, or the last two where
the last is a country and the one before is a general name (``co.uk``); an address in digits is
its own domain, without a suffix. A port, a user and a closing dot do not belong to the host's
name, and count for nothing in its reputation.

All counts are aggregates by host, so a hot host is one row before anything is joined; of the
pages only those without a rule meet the table of hosts, and Spark splits a hot host there.

Cases: an URL that is null or has no ``://`` has an empty host and path, and like any host
without labelled pages it gets what is known of all pages; labels that are null or of no page
count for nothing; with no labels at all nothing is blocked but by rules; repeated pages are
judged alike, and repeated labels of a page count each; an empty table gives an empty result;
of the columns only those named are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklens.llm.storage import stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Names below a country that are public suffixes with it.
GENERAL = ("ac", "co", "com", "edu", "gov", "net", "or", "org")


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the start of a path, like ``example.com/en/``."""

    verdict: str
    text: str

    def __post_init__(self) -> None:
        if self.verdict not in ("allow", "block") or "/" not in self.text:
            raise ValueError(f"not a rule: {self}")

    def fits(self, host: Column, path: Column) -> Column:
        own, start = self.text.split("/", 1)
        own = own.translate(str.maketrans(_UPPER, _UPPER.lower()))
        of_host = (host == own) | host.endswith("." + own)
        return of_host & path.startswith("/" + start)


@dataclass(frozen=True)
class Prior:
    """How posteriors are formed and when a host is blocked."""

    limit: float = 0.3  #: largest share of bad pages that a host may have
    z: float = 1.645  #: one-sided 95 %
    #: least and greatest likeness of the children of one parent (1 / (prior strength + 1))
    least: float = 0.001
    most: float = 0.5


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    host = F.regexp_extract(_after(url), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substr(text, at + 3, F.length(text))).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, or null. The list is part of the plan: a few hundred rules."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    fitting = [F.when(r.fits(host, path), F.lit(r.text)) for r in ordered]
    return F.coalesce(*fitting, F.lit(None).cast("string"))


def _parents(host: Column) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host."""
    name = F.regexp_replace(host, r"^[^@]*@|:[0-9]*$|\.(?::[0-9]*)?$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    last, general = F.element_at(labels, -1), F.try_element_at(labels, F.lit(-2))
    two = (F.length(last) == 2) & general.isin(*GENERAL) & (n > 2)
    width = F.when(two, 2).otherwise(1)
    digits = name.rlike(r"^[0-9.]*$|[\[\]]")
    suffix = F.array_join(F.slice(labels, n - width + 1, width), ".")
    domain = F.when(
        n > width, F.array_join(F.slice(labels, n - width, width + 1), ".")
    ).otherwise(name)
    return F.when(digits, name).otherwise(domain), F.when(digits, "").otherwise(suffix)


def _level(children: DataFrame, name: str, prior: Prior) -> Column:
    """The prior strength of a level: ``children`` has n, k and the parent's share ``above``."""
    p, n, k = F.col("above"), F.col("n"), F.col("k")
    spread = (k - n * p) * (k - n * p) - n * p * (1 - p)
    likeness = F.coalesce(
        F.try_divide(F.sum(spread), F.sum(n * (n - 1) * p * (1 - p))), F.lit(prior.most)
    )
    likeness = F.least(F.greatest(likeness, F.lit(prior.least)), F.lit(prior.most))
    return children.agg((1 / likeness - 1).alias(name))


def reputations(
    pages: DataFrame,
    outcomes: DataFrame,
    prior: Prior = Prior(),
    id_col: str = "page_id",
    url_col: str = "url",
    bad_col: str = "bad",
) -> DataFrame:
    """(host, n, k, alpha, beta, bound) of every host of ``pages``.

    ``outcomes`` has the id of a page and a boolean or 0/1 ``bad_col``; ``n`` labelled pages
    of the host, ``k`` of them bad; ``bound`` is the lower posterior bound of its bad share.
    """
    host = host_of(F.col(f"`{url_col}`")).alias("host")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host)
    labelled = outcomes.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{bad_col}`").cast("int").alias("bad")
    ).where("id IS NOT NULL AND bad IS NOT NULL")
    counts = (
        rows.join(labelled, "id").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("k"))
    )
    domain, suffix = _parents(F.col("host"))
    hosts = rows.select("host").distinct().join(counts, "host", "left").select(
        "host", domain.alias("domain"), suffix.alias("suffix"),
        F.coalesce("n", F.lit(0)).cast("double").alias("n"),
        F.coalesce("k", F.lit(0)).cast("double").alias("k"),
    )
    hosts = stored(hosts, "hosts")  # read by every level below
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    share = suffixes.agg(((F.sum("k") + 0.5) / (F.sum("n") + 1)).alias("share"))

    def shrunk(level: DataFrame) -> DataFrame:
        """The level with the prior strength and the share after its own counts."""
        strong = _level(level, "strength", prior)
        return level.withColumn("strength", strong.scalar()).withColumn(
            "share",
            (F.col("strength") * F.col("above") + F.col("k")) / (F.col("strength") + F.col("n")),
        )

    suffixes = shrunk(suffixes.withColumn("above", share.scalar()))
    above = suffixes.select("suffix", F.col("share").alias("above"))
    domains = shrunk(domains.join(above, "suffix"))
    above = domains.select("domain", "suffix", F.col("share").alias("above"))
    hosts = shrunk(hosts.join(above, ["domain", "suffix"]))
    good = F.col("strength") * (1 - F.col("above")) + F.col("n") - F.col("k")
    bad = F.col("strength") * F.col("above") + F.col("k")
    odds = F.ln(F.col("alpha") / F.col("beta")) - prior.z * F.sqrt(1 / F.col("alpha") + 1 / F.col("beta"))
    return (
        hosts.withColumn("alpha", bad)
        .withColumn("beta", good)
        .withColumn("bound", 1 / (1 + F.exp(-odds)))
        .select(
            "host", F.col("n").cast("long").alias("n"), F.col("k").cast("long").alias("k"),
            "alpha", "beta", "bound",
        )
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = (),
    prior: Prior = Prior(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every page; the verdict is ``allow`` or ``block``."""
    url = F.col(f"`{url_col}`")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("_id"), host_of(url).alias("host"), path_of(url).alias("path")
    ).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    bad = reputations(pages, outcomes, prior, id_col, url_col).where(F.col("bound") > prior.limit)
    open_host = F.when(F.col("rule").isNull(), F.col("host"))
    judged = rows.join(
        bad.select(F.col("host").alias("bad_host")), open_host == F.col("bad_host"), "left"
    )
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("rule") == r.text, F.lit(r.verdict)).otherwise(by_rule)
    by_host = F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")
    return judged.select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce(by_rule, by_host).alias("verdict"),
    )
