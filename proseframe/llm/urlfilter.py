"""URL filters: rules on hosts and paths, and trust and distrust spread over the host graph.

Built-in functions, joins and grouped sums only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.session import remove, shared_dir, write_through

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Holds for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def after_scheme(url: Column) -> Column:
    """What follows the first "://"; empty for null and for a url without it."""
    return F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does. Rules are a short list of settings."""
    tests = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(rules, key=lambda r: -len(r.name))
    ]
    return F.coalesce(*tests, F.lit(None).cast("struct<rule: string, verdict: string>"))


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): how often pages of a host link to another host, counted before the shuffle."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""), F.lit(1))
    away = F.filter(hrefs, lambda h: F.contains(h, F.lit("://")) | F.startswith(h, F.lit("//")))
    full = F.transform(away, lambda h: F.when(F.startswith(h, F.lit("//")), F.concat(F.lit("x:"), h)).otherwise(h))
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(full).alias("to"))
    links = links.select("src", host_of(F.col("to")).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def domain_links(hosts: DataFrame, labels: int = 2) -> DataFrame:
    """(src, dst, n) between each host of (host, n) and its parent domain, both ways, up to domains of ``labels`` labels.

    A site stands behind its subdomains, and they for it; ``n`` is the number of
    pages below. Parents without pages of their own take part.
    """
    parts = F.split("host", r"\.")
    up = F.sequence(F.lit(0), F.size(parts) - labels - 1)
    names = F.transform(up, lambda i: F.struct(F.array_join(F.slice(parts, i + 1, F.size(parts)), ".").alias("low"), F.array_join(F.slice(parts, i + 2, F.size(parts)), ".").alias("high")))
    steps = hosts.where((F.size(parts) > labels) & ~F.contains("host", F.lit(".."))).select("n", F.explode(names).alias("e"))
    steps = steps.groupBy(F.col("e.low").alias("low"), F.col("e.high").alias("high")).agg(F.sum("n").alias("n"))
    return steps.select(F.col("low").alias("src"), F.col("high").alias("dst"), "n").unionByName(steps.select(F.col("high").alias("src"), F.col("low").alias("dst"), "n"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = 0.85, rounds: int = 200, tolerance: float = 1e-3) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) and links (src, dst, n).

    Personalised PageRank without teleporting anywhere but to the seeds. Trust
    follows links, distrust runs against them: it reaches whoever links to a
    blocked host. Values are scaled so that a seed alone keeps its own weight.
    A round is one join on the giving host and one grouped sum, combined before
    the shuffle, for both values at once; each is written to the shared folder.
    Ends when the total change falls below ``tolerance`` of the total, and
    raises if that takes more than ``rounds`` (what is still missing shrinks by
    ``damping`` a round, so it does not at these settings).
    """
    spark = seeds.sparkSession
    paths: list[str] = []

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        paths.append(shared_dir(spark, purpose))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    sends = links.select("src", "dst", "n", F.lit(True).alias("trusts")).unionByName(
        links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n", F.lit(False).alias("trusts"))
    )
    totals = sends.groupBy("src", "trusts").agg(F.sum("n").alias("out"))
    sends = keep(sends.join(totals, ["src", "trusts"]).select("src", "dst", "trusts", (F.col("n") / F.col("out")).alias("share")), "host-links")
    start = keep(seeds.select("host", F.col("trust").cast("double").alias("trust"), F.col("distrust").cast("double").alias("distrust")), "host-seeds")
    values, old = start, None
    if sends.isEmpty():
        return start
    for _ in range(rounds):
        got = sends.join(values, F.col("src") == F.col("host"))
        sent = got.groupBy(F.col("dst").alias("host")).agg(
            F.sum(F.when(F.col("trusts"), F.col("trust") * F.col("share")).otherwise(0.0) * damping).alias("trust"),
            F.sum(F.when(F.col("trusts"), 0.0).otherwise(F.col("distrust") * F.col("share")) * damping).alias("distrust"),
        )
        after = keep(start.unionByName(sent).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "host-values")
        moved = after.withColumn("now", F.lit(1)).unionByName(values.withColumn("now", F.lit(-1)))
        both = F.when(F.col("now") > 0, F.col("trust") + F.col("distrust"))
        moved = moved.groupBy("host").agg(F.sum(F.col("trust") * F.col("now")).alias("t"), F.sum(F.col("distrust") * F.col("now")).alias("d"), F.sum(both).alias("all"))
        row = moved.agg(F.sum(F.abs("t") + F.abs("d")).alias("change"), F.sum("all").alias("total")).first()
        change, total = row["change"] or 0.0, row["total"] or 0.0
        if old:
            remove(spark, old)
        values, old = after, paths[-1]
        if change <= tolerance * max(total, 1e-12):
            return values
    raise RuntimeError(f"trust did not settle in {rounds} rounds")


def judge(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", rules=RULES, over: float = 1.5, least_share: float = 0.05, prior_pages: int = 2, damping: float = 0.85) -> DataFrame:
    """(id, host, path, rule, trust, distrust, verdict) for each page.

    A rule's verdict stands. Other pages take their host's: the seeds are the
    shares of a host's pages that rules allow (trust) and block (distrust), as
    if ``prior_pages`` more had no rule, so that a host of one page is no seed
    of full weight. They are spread over the links between hosts and between a
    host and its parent domains. A host is blocked if its distrust exceeds its
    trust ``over`` times and is at least ``least_share`` of the blocked seeds'
    mean distrust.
    Html is read once, for its links, and never shuffled. A null url, or one
    without "://", has an empty host and path and is allowed; pages without
    html have no links; repeated pages count as often as they stand; other
    columns are ignored; no pages give no rows.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    allowed, blocked = (F.count(F.when(F.col("r.verdict") == v, 1)) for v in ("allow", "block"))
    count = F.count(F.lit(1))
    counts = rows.where("host <> ''").groupBy("host").agg(allowed.alias("allowed"), blocked.alias("blocked"), count.alias("n"))
    counts = write_through(counts, "host-counts")
    weight = F.col("n") + prior_pages
    seeds = counts.select("host", (F.col("allowed") / weight).alias("trust"), (F.col("blocked") / weight).alias("distrust"))
    mean = seeds.agg(F.avg(F.when(F.col("distrust") > 0, F.col("distrust")))).first()[0] or 0.0
    links = host_links(pages, url, html).unionByName(domain_links(counts.select("host", "n")))
    hosts = spread(seeds, links.groupBy("src", "dst").agg(F.sum("n").alias("n")), damping)
    bad = (F.col("distrust") > over * F.col("trust")) & (F.col("distrust") >= least_share * mean)
    judged = rows.join(hosts, "host", "left").withColumn("by_host", F.when(bad, "block").otherwise("allow"))
    return judged.select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), "trust", "distrust", F.coalesce("r.verdict", "by_host").alias("verdict")
    )
