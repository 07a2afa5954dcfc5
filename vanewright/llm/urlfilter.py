"""URL filters from rules and path templates.

Each host has a tree of path templates: segments that vary become wildcards, branches whose labels look like their
parent's are merged with it, those that differ from it to the same side are merged with each other, and a template is
rejected by the smoothed share of blocked labels. The labels are what the rules decide; the templates judge the urls
that no rule fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import unused
from vanewright.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
#: A segment is a wildcard if it has a digit, is this long, or is rarer than one in so many of its host and level.
LONG_SEGMENT, RARE = 24, 20
#: Labels a branch needs to speak for itself; how many deviations make it differ from its parent.
LEAST_LABELS, DEVIATIONS = 5, 2.0
#: Labels that the share of all labels counts for in a template's share; the share from which it is rejected.
PRIOR, REJECT = 4.0, 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, of equally long ones the first in alphabetical order."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0]), reverse=True):
        at = rule.index("/")
        own_host, own_path = rule[:at], rule[at:]
        fits = ((host == own_host) | F.endswith(host, F.lit("." + own_host))) & F.startswith(path, F.lit(own_path))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _templates(urls: DataFrame) -> DataFrame:
    """(host, path, template, blocked, labels) per host and path. All levels are looked at together, however many a
    path has."""
    paths = urls.groupBy("host", "path").agg(
        F.count("*").alias("urls"), F.sum(F.when(F.col("verdict") == BLOCK, 1).otherwise(0)).alias("blocked"),
        F.count("verdict").alias("labels"),
    )
    paths = written(paths.withColumn("own", F.filter(F.split("path", "/", -1), lambda s: s != "")), "url-paths")
    segments = paths.select("host", "path", "urls", F.posexplode("own").alias("level", "segment"))
    # One row per (host, level, segment) first: a host's urls meet only as the segments they differ in.
    counts = segments.groupBy("host", "level", "segment").agg(F.sum("urls").alias("n"))
    totals = counts.groupBy("host", "level").agg(F.sum("n").alias("total"))
    varying = F.col("segment").rlike("[0-9]") | (F.length("segment") >= LONG_SEGMENT)
    named = counts.join(totals, ["host", "level"]).where(~varying & (F.col("n") * RARE >= F.col("total")))
    marked = segments.join(
        named.select("host", "level", "segment", F.lit(True).alias("named")), ["host", "level", "segment"], "left"
    )
    kept = F.struct("level", F.when(F.col("named"), F.col("segment")).otherwise("*").alias("step"))
    templates = marked.groupBy("host", "path").agg(F.sort_array(F.collect_list(kept)).alias("steps"))
    template = F.coalesce(F.transform("steps", lambda s: s.step), F.array().cast("array<string>"))
    return paths.join(templates, ["host", "path"], "left").select("host", "path", template.alias("template"), "blocked", "labels")


def template_verdicts(urls: DataFrame) -> DataFrame:
    """(host, path, template, share, rejected) of urls given as (host, path, verdict or null).

    A branch of a host's tree speaks for itself if it has at least ``LEAST_LABELS`` labels and its share of blocked ones
    lies more than ``DEVIATIONS`` standard deviations from its parent's; the children of one branch that lie to the same
    side of it speak together. A template gets the labels of its deepest branch that speaks for itself, else those of its
    host. It is rejected if most of these block, and do so as well with the share of all labels added as a few more; where
    a host has no labels nothing is.
    """
    paths = written(_templates(urls), "url-templates")
    overall = paths.agg(F.sum("blocked") / F.greatest(F.sum("labels"), F.lit(1))).first()[0] or 0.0
    # A tree is small however many urls its host has: what varies became a wildcard.
    branches = paths.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("labels").alias("labels"))
    branches = written(branches.withColumn("depth", F.explode(F.sequence(F.lit(0), F.size("template")))).withColumn(
        "node", F.slice("template", F.lit(1), F.col("depth"))
    ), "url-branches")
    nodes = written(branches.groupBy("host", "node", "depth").agg(
        F.sum("blocked").alias("blocked"), F.sum("labels").alias("labels")
    ), "url-nodes")
    parents = nodes.select("host", F.col("node").alias("parent"), F.try_divide("blocked", "labels").alias("before"))
    children = nodes.where((F.col("depth") > 0) & (F.col("labels") >= LEAST_LABELS)).withColumn(
        "parent", F.slice("node", F.lit(1), F.col("depth") - 1)
    )
    share, before = F.try_divide("blocked", "labels"), F.col("before")
    differing = children.join(parents.where(before.isNotNull()), ["host", "parent"]).where(
        F.abs(share - before) > DEVIATIONS * F.sqrt(before * (1 - before) / F.col("labels"))
    ).withColumn("above", share > before)
    pools = differing.groupBy("host", "parent", "above").agg(F.sum("blocked").alias("b"), F.sum("labels").alias("n"))
    own = differing.join(pools, ["host", "parent", "above"]).select("host", "node", "b", "n")
    roots = nodes.where("depth = 0").select("host", "node", F.col("blocked").alias("b"), F.col("labels").alias("n"))
    spoken = branches.join(own.unionByName(roots), ["host", "node"]).groupBy("host", "template").agg(
        F.max_by(F.struct("b", "n"), "depth").alias("pool")
    ).select("host", "template", "pool.*")
    smoothed = (F.col("b") + PRIOR * overall) / (F.col("n") + PRIOR)
    rejected = (F.col("n") > 0) & (F.col("b") >= REJECT * F.col("n")) & (smoothed >= REJECT)
    shares = spoken.select("host", "template", smoothed.alias("share"), rejected.alias("rejected"))
    return paths.select("host", "path", "template").join(shares, ["host", "template"])


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict, template and share added, one row per page.

    Rules are (``host/path`` beginning, allow or block); the longest that fits decides. Other urls get the verdict of
    their path template, and allow where their host has no labels. A null url, and one without ``://``, has an empty host
    and path, on which the template of the empty host decides. Paths are looked at in all their segments, however many;
    a branch as far from its parent as the bound does not differ. Repeated urls get equal verdicts, and each counts. An
    empty table gives no rows. Other columns stay; clashing names get a trailing underscore.
    """
    names = {}
    for name in ("host", "path", "rule", "verdict", "template", "share"):
        names[name] = unused(pages, name)
    parsed = pages.withColumns({names["host"]: host_of(F.col(url)), names["path"]: path_of(F.col(url))})
    found = rule_of(F.col(names["host"]), F.col(names["path"]), rules)
    urls = parsed.select(F.col(names["host"]).alias("host"), F.col(names["path"]).alias("path"),
                         found["verdict"].alias("verdict"))
    verdicts = template_verdicts(urls).select(F.struct("*").alias("_t")).select(
        F.col("_t.host").alias("_host"), F.col("_t.path").alias("_path"), F.col("_t").alias("_template")
    )
    keep = [F.col(c) for c in parsed.columns]
    joined = parsed.join(
        verdicts, (parsed[names["host"]] == verdicts["_host"]) & (parsed[names["path"]] == verdicts["_path"]), "left"
    )
    by_template = F.when(F.col("_template.rejected"), BLOCK).otherwise(ALLOW)
    return joined.select(
        *keep, found["rule"].alias(names["rule"]), F.coalesce(found["verdict"], by_template).alias(names["verdict"]),
        F.array_join("_template.template", "/").alias(names["template"]),
        F.col("_template.share").alias(names["share"]),
    )
