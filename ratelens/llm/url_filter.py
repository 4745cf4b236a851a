"""URL filters: fixed rules first, then a tree of path templates for each host."""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.checkpoints import checkpointed

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains, and paths that start as ``prefix`` does from its first slash on."""

    prefix: str
    verdict: str


@dataclass(frozen=True)
class Tree:
    """How templates are made and judged.

    A segment below the same parent becomes a wildcard if the parent has
    ``children`` segments or more and this one is on under ``share`` of its
    urls. Paths have ``depth`` segments, the last holding all that follows.
    Branches that differ in one segment are merged if each has ``labels``
    labelled urls or more and none's blocked share is ``z`` standard errors or
    more from that of all. A branch with fewer joins such ones, or a single one,
    if its pages and its paths are as many as theirs on average, within ``z``
    standard errors of a count, and its own few labels agree with theirs. A
    template is rejected if it has ``labels`` labelled urls or more and its
    blocked share, smoothed by ``smoothing`` urls of the overall share, is
    ``purity`` or more.
    """

    depth: int = 4
    children: int = 20
    share: float = 0.05
    labels: int = 5
    z: float = 2.0
    smoothing: float = 4.0
    purity: float = 0.8


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Prefix and verdict of the longest rule that fits, of equal ones the first; NULL without any."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda rule: len(rule.prefix)):  # later ones, longer or given before, decide
        name, slash, rest = rule.prefix.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        value = F.struct(F.lit(rule.prefix).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


def _segments(path: Column, depth: int) -> Column:
    """``depth`` segments, numbers in them replaced; missing ones are NULL."""
    every = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "<n>"), "/")
    head = F.slice(every, 1, depth - 1)
    tail = F.array_join(F.slice(every, depth, F.greatest(F.size(every) - depth + 1, F.lit(0))), "/")
    return F.when(F.size(every) >= depth, F.concat(head, F.array(tail))).otherwise(head)


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right``, where NULL equals NULL; ``right`` gives its other columns only."""
    named = right.withColumnsRenamed({key: f"right_{key}" for key in keys})
    same = reduce(Column.__and__, (F.col(key).eqNullSafe(F.col(f"right_{key}")) for key in keys))
    return left.join(named, same, how).drop(*(f"right_{key}" for key in keys))


def _generalised(paths: DataFrame, level: int, tree: Tree) -> DataFrame:
    """Rare segments of parents with many become wildcards."""
    parent = ["host", *(f"s{n}" for n in range(level))]
    here = f"s{level}"
    own = paths.filter(F.col(here).isNotNull()).groupBy(*parent, here).agg(F.sum("n").alias("own"))
    whole = own.groupBy(parent).agg(F.count("*").alias("children"), F.sum("own").alias("whole"))
    variable = (F.col("children") >= tree.children) & (F.col("own") < tree.share * F.col("whole"))
    rare = _matched(own, whole, parent).filter(variable).select(*parent, here, F.lit(True).alias("rare"))
    segment = F.when(F.col("rare"), F.lit("*")).otherwise(F.col(here))
    return _matched(paths, rare, [*parent, here], "left").withColumn(here, segment).drop("rare")


def _merged(templates: DataFrame, level: int, tree: Tree) -> DataFrame:
    """Branches that differ in this segment alone, with like blocked shares, share a wildcard.

    A branch with too few labels of its own joins if it has as many pages and
    paths as its labelled siblings and no other blocked share; one without any
    only if the same branch of other hosts has labels enough, with that share,
    and two siblings or more agree.
    """
    here = f"m{level}"
    names = [f"m{n}" for n in range(tree.depth)]
    rest = ["host", *(name for name in names if name != here)]
    sums = (F.sum(name).alias(name) for name in ("labelled", "blocked", "pages", "paths"))
    branch = templates.groupBy("host", *names).agg(*sums).filter(F.col(here).isNotNull())
    sure = branch.filter(F.col("labelled") >= tree.labels)
    pooled = sure.groupBy(rest).agg(
        (F.sum("blocked") / F.sum("labelled")).alias("p"),
        F.avg("pages").alias("mean_pages"),
        F.avg("paths").alias("mean_paths"),
    )

    def excess(labelled: str, blocked: str) -> Column:
        error = F.sqrt(F.col("p") * (1 - F.col("p")) / F.col(labelled))
        return F.abs(F.col(blocked) / F.col(labelled) - F.col("p")) - tree.z * error

    agreed = (
        _matched(sure, pooled, rest)
        .groupBy(rest)
        .agg(F.max(excess("labelled", "blocked")).alias("excess"), F.count("*").alias("siblings"))
        .filter("excess <= 0")
    )
    # the same branch on all hosts: the only evidence on one without labels of its own
    elsewhere = branch.groupBy(names).agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
    counts = reduce(
        Column.__and__,
        (F.abs(F.col(x) - F.col(f"mean_{x}")) <= tree.z * F.sqrt(f"mean_{x}") for x in ("pages", "paths")),
    )
    known = (F.col("all_labelled") >= tree.labels) & (excess("all_labelled", "all_blocked") <= 0) & (F.col("siblings") > 1)
    own = F.when(F.col("labelled") > 0, excess("labelled", "blocked") <= 0).otherwise(known)
    like = (
        _matched(_matched(_matched(branch, pooled, rest), agreed, rest), elsewhere, names)
        .filter((F.col("labelled") >= tree.labels) | (counts & own))
        .groupBy(rest)
        .agg(F.collect_set(here).alias("alike"))  # few: rare ones are wildcards by now
        .filter(F.size("alike") > 1)
    )
    segment = F.when(F.array_contains("alike", F.col(here)), F.lit("*")).otherwise(F.col(here))
    return _matched(templates, like, rest, "left").withColumn(here, segment).drop("alike")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    tree: Tree = Tree(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One verdict for each row of ``pages``.

    Columns: page_id, host, path, rule (prefix of the rule that decided, or
    NULL), verdict (allow or block), template and purity (smoothed blocked
    share of its labelled urls). Urls that a rule decides are the labelled ones;
    the others get their template's verdict. A NULL url, or one without ``://``,
    has an empty host and path, and is judged like any other; repeated rows
    repeat their verdict and count each; without any labelled url all are
    allowed. Only DataFrame functions; urls are counted by host and path before
    any shuffle, so a hot host is as long as it has distinct paths.
    """
    own = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    named = own.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    decided = named.withColumn("decided", rule_of(F.col("host"), F.col("path"), rules))
    levels = range(tree.depth)
    segments = _segments(F.col("path"), tree.depth)
    paths = checkpointed(
        decided.groupBy("host", "path")
        .agg(
            F.count("*").alias("n"),
            F.count("decided").alias("labelled"),
            F.count_if(F.col("decided.verdict") == "block").alias("blocked"),
        )
        .select("*", *(F.get(segments, F.lit(n)).alias(f"s{n}") for n in levels))
    )
    for level in levels:
        paths = checkpointed(_generalised(paths, level, tree))
    segment_names = [f"s{n}" for n in levels]
    templates = paths.groupBy("host", *segment_names).agg(
        F.sum("labelled").alias("labelled"),
        F.sum("blocked").alias("blocked"),
        F.sum("n").alias("pages"),
        F.count("*").alias("paths"),
    )
    templates = checkpointed(templates.select("*", *(F.col(f"s{n}").alias(f"m{n}") for n in levels)))
    for level in reversed(levels):
        templates = checkpointed(_merged(templates, level, tree))
    merged = ["host", *(f"m{n}" for n in levels)]
    sums = templates.groupBy(merged).agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
    overall = templates.agg(F.coalesce(F.try_divide(F.sum("blocked"), F.sum("labelled")), F.lit(0.0)).alias("share")).first()["share"]
    purity = (F.col("all_blocked") + tree.smoothing * overall) / (F.col("all_labelled") + tree.smoothing)
    template = F.concat(F.lit("/"), F.concat_ws("/", *merged[1:]))
    rejected = (F.col("all_labelled") >= tree.labels) & (purity >= tree.purity)
    judged = _matched(templates, sums, merged).select(
        "host", *segment_names, template.alias("template"), purity.alias("purity"), rejected.alias("rejected")
    )
    of_path = _matched(paths, judged, ["host", *segment_names]).select("host", "path", "template", "purity", "rejected")
    judged_pages = _matched(decided, of_path, ["host", "path"])
    return judged_pages.select(
        "page_id",
        "host",
        "path",
        F.col("decided.rule").alias("rule"),
        F.coalesce(
            F.col("decided.verdict"), F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
        "template",
        "purity",
    )
