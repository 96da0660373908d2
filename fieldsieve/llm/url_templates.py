"""URL filter by host rules and, where no rule fits, by path templates learnt per host.

The paths of a host form a tree. Level by level a segment becomes a wildcard when it is one of
many rare ones under its parent, and sibling branches that go on alike and are labelled alike are
merged. The rules' own verdicts label the pages they fit; a template is rejected when its smoothed
share of blocked pages among its labelled pages is high. Everything is DataFrame code; the tree is
built from one row per host and path shape, aggregated before anything is shuffled, so a host that
holds a third of all pages costs no more than its distinct shapes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

WILD = "*"
DEEPER = "**"
END = "$"

_AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; A–Z lower-cased.

    Empty for null and where there is no ``://``.
    """
    found = F.coalesce(F.regexp_extract(url, _AUTHORITY, 1), F.lit(""))
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, _AUTHORITY, 2), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``rule`` is host, then path from its first ``/`` on; ``verdict`` is allow or block."""

    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return self.rule[len(self.host) :]


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits host and path, as struct (length, rule, verdict), or null.

    The rules are a literal of the plan, looked up by the host and each domain above it: a list
    kept by people, not a table that grows with the corpus. Rules of equal length that both fit
    are ordered by their text, the later one wins.
    """
    by_host: dict[str, list[dict]] = {}
    for r in rules:
        entry = {"length": len(r.rule), "rule": r.rule, "verdict": r.verdict, "path": r.path}
        by_host.setdefault(r.host, []).append(entry)
    kind = "map<string,array<struct<length:int,rule:string,verdict:string,path:string>>>"
    known = F.from_json(F.lit(json.dumps(by_host)), kind)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fitting = F.filter(
        F.flatten(F.filter(F.transform(domains, lambda d: known[d]), lambda x: x.isNotNull())),
        lambda r: path.startswith(r["path"]),
    )
    return F.array_max(fitting)


def path_shape(path: Column) -> Column:
    """The segments of a path with numbers and long hexadecimal ids already made wildcards."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(
        segments,
        lambda s: F.regexp_replace(
            F.regexp_replace(s, r"(?i)(?=[0-9a-f-]*[0-9])[0-9a-f-]{12,}", "{id}"),
            r"[0-9]+",
            "{n}",
        ),
    )


@dataclass(frozen=True)
class TreeSettings:
    """A segment is variable when its parent has ``min_children`` or more different ones and it
    holds less than ``min_share`` of the parent's pages. Branches are merged when at most
    ``max_distance`` of their next segments (total variation) and ``max_rate_gap`` of their
    blocked share differ from the branches they join. Templates go ``max_depth`` segments deep;
    what lies below is one ``**``. ``weight`` is how many labelled pages the corpus-wide share of
    blocked pages counts for when a template's share is smoothed; at ``reject`` or above the
    template is rejected."""

    min_children: int = 16
    min_share: float = 0.02
    max_distance: float = 0.2
    max_rate_gap: float = 0.15
    max_depth: int = 4
    weight: float = 4.0
    reject: float = 0.8


def _level(nodes: DataFrame, level: int, s: TreeSettings) -> DataFrame:
    """Add one level to every template: ``nodes`` has host, shape, template, n, good, bad."""
    here = nodes.withColumn("child", F.get("shape", F.lit(level))).withColumn(
        "next", F.coalesce(F.get("shape", F.lit(level + 1)), F.lit(END))
    )
    open_ = here.where(F.col("child").isNotNull())
    parent = ["host", "template"]
    children = open_.groupBy(*parent, "child").agg(F.sum("n").alias("n"))
    parents = children.groupBy(*parent).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n").alias("n_parent")
    )
    rare = (F.col("n_children") >= s.min_children) & (F.col("n") < s.min_share * F.col("n_parent"))
    named = children.join(parents, parent).select(
        *parent, "child", F.when(rare, WILD).otherwise(F.col("child")).alias("label")
    )
    branches = open_.join(named, [*parent, "child"])

    # Branches that may be merged share the commonest next segment and a fifth of the scale of
    # blocked shares; of those, each is compared with all of them together.
    ways = branches.groupBy(*parent, "label", "next").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad")
    )
    profile = ways.groupBy(*parent, "label").agg(
        F.sum("n").alias("n_label"),
        F.max(F.struct("n", "next"))["next"].alias("commonest"),
        F.sum("good").alias("good_label"),
        F.sum("bad").alias("bad_label"),
    )
    labelled = F.col("good_label") + F.col("bad_label")
    profile = profile.withColumn("rate", F.try_divide(F.col("bad_label"), labelled))
    profile = profile.withColumn("fifth", F.coalesce(F.floor(F.col("rate") * 4.999), F.lit(-1)))
    pool = [*parent, "commonest", "fifth"]
    pools = profile.groupBy(*pool).agg(
        F.sum("n_label").alias("n_pool"),
        F.count(F.lit(1)).alias("n_branches"),
        F.try_divide(F.sum("bad_label"), F.sum(labelled)).alias("rate_pool"),
    )
    known = profile.join(pools, pool)
    pool_ways = (
        ways.join(profile.select(*parent, "label", "commonest", "fifth"), [*parent, "label"])
        .groupBy(*pool, "next")
        .agg(F.sum("n").alias("n_way_pool"))
    )
    # Total variation: 1 minus the overlap, and only next segments the branch has can overlap.
    overlap = (
        ways.join(known, [*parent, "label"])
        .join(pool_ways, [*pool, "next"])
        .groupBy(*parent, "label", "fifth", "commonest")
        .agg(
            F.sum(
                F.least(
                    F.col("n") / F.col("n_label"), F.col("n_way_pool") / F.col("n_pool")
                )
            ).alias("overlap"),
            F.max("n_branches").alias("n_branches"),
            F.max(F.abs(F.col("rate") - F.col("rate_pool"))).alias("gap"),
        )
    )
    alike = (
        (F.col("n_branches") > 1)
        & (F.col("overlap") >= 1 - s.max_distance)
        & (F.coalesce(F.col("gap"), F.lit(0.0)) <= s.max_rate_gap)
    )
    merged = F.concat(F.lit("{"), F.col("fifth").cast("string"), F.lit("|"),
                      F.col("commonest"), F.lit("}"))
    final = overlap.select(*parent, "label", F.when(alike, merged).otherwise(F.col("label"))
                           .alias("branch"))
    going_on = branches.join(final, [*parent, "label"]).select(
        "host", "shape", F.concat_ws("/", "template", "branch").alias("template"),
        "n", "good", "bad",
    )
    ended = here.where(F.col("child").isNull()).select(*going_on.columns)
    return pin(going_on.unionByName(ended), "url-tree")


def learn_templates(labelled: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """Templates of rows (host, shape, verdict): one row per host and shape with ``template``,
    ``n_labelled``, ``purity`` (the smoothed share of blocked pages) and ``rejected``.

    A null verdict is an unlabelled page. No rows give no templates; without any label nothing is
    rejected.
    """
    count = F.count(F.lit(1))
    nodes = pin(
        labelled.groupBy("host", "shape").agg(
            count.alias("n"),
            F.count_if(F.col("verdict") == "allow").alias("good"),
            F.count_if(F.col("verdict") == "block").alias("bad"),
        ),
        "url-shapes",
    ).withColumn("template", F.lit(""))
    for level in range(settings.max_depth):
        nodes = _level(nodes, level, settings)
    deeper = F.size("shape") > settings.max_depth
    nodes = nodes.withColumn(
        "template",
        F.when(deeper, F.concat_ws("/", "template", F.lit(DEEPER))).otherwise(F.col("template")),
    )
    labels = F.sum(F.col("good") + F.col("bad"))
    base = nodes.agg(F.try_divide(F.sum("bad"), labels).alias("base"))
    totals = nodes.groupBy("host", "template").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad")
    )
    n = F.col("good") + F.col("bad")
    share = F.coalesce(F.col("base"), F.lit(0.0))
    # One row, the whole corpus's share, goes to every template.
    judged = totals.join(F.broadcast(base)).select(
        "host",
        "template",
        n.alias("n_labelled"),
        ((F.col("bad") + settings.weight * share) / (n + settings.weight)).alias("purity"),
    )
    judged = judged.withColumn(
        "rejected", (F.col("n_labelled") > 0) & (F.col("purity") >= settings.reject)
    )
    return nodes.select("host", "shape", "template").join(judged, ["host", "template"])


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    settings: TreeSettings = TreeSettings(),
) -> DataFrame:
    """Key, host, path, rule, verdict, template and purity of every row of ``pages``.

    The verdict is the longest fitting rule's, else block where the template is rejected, else
    allow. A url that is null or has no ``://`` has an empty host and path, which are judged like
    any other. Repeated rows stay repeated, null keys stay null, other columns are not read; no
    rows give no rows.
    """
    parsed = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = parsed.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules)).select(
        key,
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.col("found.verdict").alias("ruled"),
        path_shape(F.col("path")).alias("shape"),
    )
    learnt = learn_templates(ruled.select("host", "shape", F.col("ruled").alias("verdict")), settings)
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return ruled.join(learnt, ["host", "shape"], "left").select(
        key, "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
