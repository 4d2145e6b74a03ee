"""URL filter: listed rules first, then the reputation of the host.

Reputation is an empirical-Bayes estimate of the share of bad pages. Labelled
outcomes are counted by host once and written; hosts add up to registered domains and
public suffixes (the longest one of a list or table that ends the host, else its last label; a port
counts for no level); each level
is a beta-binomial whose prior mean is its parent's posterior mean (the suffix's
parent is the whole table) and whose prior strength comes from the spread of
the level's rates around their parents' (method of moments). A host without
labels has its domain's estimate. A page is blocked where the lower bound of
the host's posterior, mean - z * standard deviation, exceeds ``limit``.

DataFrame functions only. Counts are partial sums; hosts join back to pages
with a salt, so a host with a third of all pages spreads over ``salts`` tasks.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule can fit it, and it shares the estimate of the empty host; labels without a
page are ignored; several labels of one page count once, as bad if any is; a
page without a label counts for no outcome; equal rows are judged equally; a host that is
a public suffix is its own domain; only the columns named below are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrank.llm.tables import saved
from docrank.operators.util import fits, maybe_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Public suffixes of two labels that the tables may hold.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "com.ar", "com.au", "com.br", "com.cn",
                      "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk"]


def url_host(url: str) -> Column:
    rest = F.substring(F.col(url), F.instr(F.col(url), "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.instr(F.col(url), "://") > 0, host).otherwise(F.lit(""))


def url_path(url: str) -> Column:
    rest = F.substring(F.col(url), F.instr(F.col(url), "://") + 3, F.length(url))
    return F.when(F.instr(F.col(url), "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of ``rules`` (host, path, verdict) that fits, as struct(rule, verdict); null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _levels(hosts: DataFrame, suffixes: list[str] | DataFrame) -> DataFrame:
    """Adds ``suffix`` and ``domain`` (one label more) to a table of hosts, one row each."""
    parts = F.split(F.regexp_replace("host", ":[0-9]*$", ""), r"\.")
    # A host's ends from the longest (itself) to its last label.
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = hosts.withColumn("ends", ends)
    if isinstance(suffixes, DataFrame):
        known = suffixes.select(F.lower("suffix").alias("end")).where("end IS NOT NULL").distinct()
        found = hosts.select("host", F.posexplode("ends").alias("place", "end")).join(
            maybe_broadcast(known, fits(known)), "end").groupBy("host").agg(F.min("place").alias("place"))
        hosts = hosts.join(found, "host", "left").withColumn("place", F.coalesce("place", F.size("ends") - 1))
    else:
        listed = F.transform("ends", lambda e: e.isin(list(suffixes)))
        hosts = hosts.withColumn("place", F.when(F.array_contains(listed, True), F.array_position(listed, True).cast("int") - 1).otherwise(F.size("ends") - 1))
    return hosts.withColumn("suffix", F.col("ends")[F.col("place")]).withColumn(
        "domain", F.col("ends")[F.greatest(F.col("place") - 1, F.lit(0))]).drop("ends", "place")


def _strength(level: DataFrame) -> float:
    """Prior strength of a level with columns n, bad and prior (its parent's mean): (1 - r) / r for
    the within-parent correlation r that explains the weighted spread of its rates."""
    v = F.col("prior") * (1 - F.col("prior"))
    row = level.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) / v).alias("s"),
        F.count("*").alias("groups"), F.sum("n").alias("n")).first()
    if not row["groups"] or row["n"] <= row["groups"]:
        return 1.0
    r = (row["s"] - row["groups"]) / (row["n"] - row["groups"])
    r = min(max(r, 1e-4), 0.999)
    return (1 - r) / r


def host_reputation(outcomes: DataFrame, z: float = 1.645, suffixes: list[str] | DataFrame = TWO_LABEL_SUFFIXES) -> DataFrame:
    """Per host: n, bad, posterior mean and lower bound. ``outcomes``: host, bad (1, 0, or null without a label)."""
    counts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = saved(_levels(counts, suffixes), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    base = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)
    count = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrink(level: DataFrame, name: str) -> tuple[DataFrame, float]:
        k = _strength(level)
        return level.withColumn(name, (F.col("bad") + k * F.col("prior")) / (F.col("n") + k)), k

    suffixes, _ = shrink(hosts.groupBy("suffix").agg(*count).withColumn("prior", F.lit(base)), "mean")
    domains = hosts.groupBy("suffix", "domain").agg(*count).join(
        suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains, _ = shrink(domains, "mean")
    hosts = hosts.join(domains.select("suffix", "domain", F.col("mean").alias("prior")), ["suffix", "domain"])
    hosts, k = shrink(hosts, "mean")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + k + 1))
    return hosts.select("host", "n", "bad", "mean", (F.col("mean") - z * spread).alias("bound"))


def url_filter(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", limit: float = 0.5, z: float = 1.645, salts: int = 16,
               suffixes: list[str] | DataFrame = TWO_LABEL_SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's posterior ``mean`` and ``bound`` per page.

    ``labels``: ``doc_id`` (a page's id) and ``bad`` (0 or 1). ``suffixes``: public suffixes of more than one label, a list or a
    table with the column ``suffix``.
    """
    base = pages.select(F.col(id_col).alias("page_id"), url_host(url_col).alias("host"), url_path(url_col).alias("path"))
    marks = labels.where("bad IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max("bad").cast("long").alias("bad"))
    known = host_reputation(base.select("page_id", "host").join(marks, "page_id", "left"), z, suffixes)
    spread = known.select("host", "mean", "bound", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = base.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(salts)).cast("int"))
    hit = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return salted.join(spread, ["host", "salt"]).withColumn("hit", hit).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), own).alias("verdict"), "mean", "bound")
