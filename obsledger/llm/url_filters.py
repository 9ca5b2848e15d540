"""URL filters: fixed rules first, then the reputation of the host."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.llm.tables import Scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEVELS = ("all", "suffix", "domain", "host")
# Public suffixes of two labels that are taken as such by default; give more of them as ``suffixes``.
TWO_LABEL_SUFFIXES = (
    "ac.jp", "ac.uk", "appspot.com", "blogspot.com", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za",
    "com.ar", "com.au", "com.br", "com.cn", "com.hk", "com.mx", "com.sg", "com.tr", "com.tw", "com.ua",
    "edu.au", "edu.cn", "github.io", "gitlab.io", "go.jp", "gov.au", "gov.uk", "herokuapp.com", "ne.jp", "net.au",
    "netlify.app", "or.jp", "org.au", "org.uk", "pages.dev", "vercel.app", "web.app",
)


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def site_of(host: Column) -> Column:
    """The host without user, port and closing dot: the name that reputations go by."""
    bare = F.regexp_replace(host, r"(?s)^.*@", "")
    return F.regexp_replace(bare, r"\.?(?::[0-9]*)?$", "")


def suffix_of(site: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The last two labels if they are one of ``suffixes``, else the last label."""
    two = F.substring_index(site, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(site, ".", -1))


def domain_of(site: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The registered domain: the suffix and the label before it."""
    two = F.substring_index(site, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(site, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (of equals, the one with the longer host), as struct(rule, verdict)."""
    fitting = []
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
        fitting.append(F.when(fits, found))
    if not fitting:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fitting)


def reputation(
    outcomes: DataFrame, z: float = 1.645, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES
) -> DataFrame:
    """Posterior of the share of good pages for each name of each level.

    ``outcomes`` has ``host`` and ``good`` (boolean; null: not labelled, left
    out). Gives level, name, mean, bound. Each level's names share one
    beta-binomial prior strength, found by moments: Pearson's statistic of the
    names around their parents' means against what overdispersion rho would
    make it. A name's prior is its parent's posterior mean with that strength;
    bound is the mean less ``z`` posterior standard deviations. The top level
    is one row and starts from a uniform prior; without labels its mean is 1/2.

    Host names are those of ``site_of``; a null host counts as the empty one.
    ``suffixes`` are the suffixes of two labels (a short list of literals).
    The hosts' counts and each level are written once, as each is read twice.
    """
    scratch = Scratch(outcomes.sparkSession, "reputation")
    counts = scratch.keep(
        outcomes.where(F.col("good").isNotNull())
        .groupBy(site_of(F.coalesce("host", F.lit(""))).alias("host"))
        .agg(F.count("*").alias("n"), F.sum(F.col("good").cast("bigint")).alias("k")),
        "counts",
    )
    top = counts.agg(
        (F.coalesce(F.sum("k"), F.lit(0)) + 1.0).alias("_a"),
        (F.coalesce(F.sum("n") - F.sum("k"), F.lit(0)) + 1.0).alias("_b"),
    ).select(F.lit("all").alias("level"), F.lit("").alias("name"), "_a", "_b")
    named = counts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn(
        "suffix", suffix_of(F.col("host"), suffixes)
    )
    name = F.col("name")
    parents = {"suffix": F.lit(""), "domain": suffix_of(name, suffixes), "host": domain_of(name, suffixes)}
    levels = [scratch.keep(top, "all")]
    for level in LEVELS[1:]:
        above = levels[-1].select(
            F.col("name").alias("_parent"), (F.col("_a") / (F.col("_a") + F.col("_b"))).alias("_m")
        )
        own = scratch.keep(
            named.groupBy(F.col(level).alias("name"))
            .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
            .withColumn("_parent", parents[level])
            .join(above, "_parent"),
            f"{level}-counts",
        )
        spread = F.sum((F.col("k") - F.col("n") * F.col("_m")) ** 2 / (F.col("n") * F.col("_m") * (1 - F.col("_m"))))
        # Null where no name occurs twice.
        rho = F.try_divide(spread - F.count("*"), F.sum(F.col("n") - 1))
        # One row: the strength of this level's prior.
        strength = own.agg(
            F.least(F.lit(0.99), F.greatest(F.lit(0.001), F.coalesce(rho, F.lit(0.5)))).alias("_rho")
        ).select((1 / F.col("_rho") - 1).alias("_s"))
        posterior = own.crossJoin(F.broadcast(strength)).select(
            F.lit(level).alias("level"),
            "name",
            (F.col("k") + F.col("_m") * F.col("_s")).alias("_a"),
            (F.col("n") - F.col("k") + (1 - F.col("_m")) * F.col("_s")).alias("_b"),
        )
        levels.append(scratch.keep(posterior, level))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    mean = F.col("_a") / (F.col("_a") + F.col("_b"))
    deviation = F.sqrt(mean * (1 - mean) / (F.col("_a") + F.col("_b") + 1))
    return out.select("level", "name", mean.alias("mean"), (mean - z * deviation).alias("bound"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    url_col: str = "url",
    least_good: float = 0.7,
    z: float = 1.645,
    suffixes: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, evidence (the level that decided) and bound.

    The longest fitting rule decides. Where none fits, the lower posterior
    bound of the host decides, or of the nearest level above that has labels:
    ``allow`` from ``least_good`` on, else ``block``. A null url has an empty
    host and path and is judged by the top level. ``suffixes`` as in
    ``reputation``. Every row comes out once;
    further columns pass through, those of the names above are replaced.
    """
    new = ["host", "path", "rule", "verdict", "evidence", "bound"]
    url = F.col("_url")
    ruled = (
        pages.withColumn("_url", F.col(url_col))
        .drop(*new)
        .withColumn("host", host_of(url))
        .withColumn("path", path_of(url))
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    )
    known = reputation(outcomes, z, suffixes)
    # Judge each host once; pages then look their host up.
    site = site_of(F.col("host"))
    hosts = ruled.select("host").distinct().select(
        "host",
        site.alias("_site"),
        domain_of(site, suffixes).alias("_domain"),
        suffix_of(site, suffixes).alias("_suffix"),
    )
    of = {}
    for level in LEVELS:
        of[level] = known.where(F.col("level") == level).select(
            F.col("name").alias(f"_n_{level}"), F.col("bound").alias(f"_b_{level}")
        )
    judged = (
        hosts.join(of["host"], F.col("_site") == F.col("_n_host"), "left")
        .join(of["domain"], F.col("_domain") == F.col("_n_domain"), "left")
        .join(of["suffix"], F.col("_suffix") == F.col("_n_suffix"), "left")
        .crossJoin(F.broadcast(of["all"]))  # one row
    )
    nearest = F.coalesce(*[F.col(f"_b_{x}") for x in reversed(LEVELS)])
    evidence = F.coalesce(*[F.when(F.col(f"_b_{x}").isNotNull(), x) for x in reversed(LEVELS)])
    judged = judged.select(F.col("host").alias("_host"), nearest.alias("bound"), evidence.alias("evidence"))
    method = F.when(F.col("bound") >= least_good, "allow").otherwise("block")
    return (
        ruled.join(judged, F.col("host") == F.col("_host"), "left")
        .withColumn("rule", F.col("_rule.rule"))
        .withColumn("verdict", F.coalesce(F.col("_rule.verdict"), method))
        .withColumn("evidence", F.when(F.col("_rule").isNotNull(), "rule").otherwise(F.col("evidence")))
        .drop("_url", "_rule", "_host")
    )
