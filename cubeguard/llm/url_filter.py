"""URL filter: rules first, else a tree of path templates for each host.

Below each host, the paths' segments form a tree. From the root on, a segment that
is rare among its siblings becomes a wildcard of its shape (``{n}`` for digits, else
``*``); siblings whose block rates and next segments do not differ statistically are
merged into one branch, the most alike first. Rates are smoothed, so a branch with few
labels or none is compared like any other. The tree is as deep as any template has enough
URLs; below, each segment is ``*``. A template (host and generalised path) is
rejected where it has enough labelled URLs and its block rate, smoothed by the rate
of all labelled URLs, is high. URLs that a rule decides are the labels.

Every level is one map-side combined aggregate of distinct paths by (host, template,
segment); a hot host's paths are spread by their segments, and the join back can be
split. Nothing but two totals, and whether a level is the last, comes to the driver.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import ship_code, store

#: (verdict, host, path), as in the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: A segment stays literal with so many URLs and this share of its siblings'.
MIN_SUPPORT, MIN_SHARE = 5, 0.02
#: Siblings are merged while neither rate nor next segments differ by so many standard errors.
ALIKE = 1.64
#: Weight of the rate of all labelled URLs in a sibling's, as they are compared.
SIBLING_WEIGHT = 1.0
#: A template is rejected with so many labels and this smoothed block rate.
MIN_LABELLED, PURITY, PRIOR_WEIGHT = 5, 0.9, 2.0
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host or a parent host, and the path's start."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


class Branch:
    """Siblings merged so far: names, URLs, bad and labelled ones, URLs by next segment."""

    __slots__ = ("names", "n", "bad", "seen", "nexts")

    def __init__(self, names: list[str], n: int, bad: int, seen: int, nexts: dict):
        self.names, self.n, self.bad, self.seen, self.nexts = names, n, bad, seen, nexts

    def __add__(self, other: Branch) -> Branch:
        nexts = {k: self.nexts.get(k, 0) + other.nexts.get(k, 0) for k in {**self.nexts, **other.nexts}}
        return Branch(sorted(self.names + other.names), self.n + other.n, self.bad + other.bad, self.seen + other.seen, nexts)

    def rate(self, prior: float) -> tuple[float, float]:
        """Mean and variance of the block rate, given the labels."""
        weight = self.seen + SIBLING_WEIGHT
        mean = (self.bad + SIBLING_WEIGHT * prior) / weight
        return mean, mean * (1 - mean) / (weight + 1)


def _rates_differ(a: Branch, b: Branch, prior: float) -> float:
    (x, v), (y, w) = a.rate(prior), b.rate(prior)
    return abs(x - y) / math.sqrt(v + w) if v + w > 0 else 0.0 if x == y else math.inf


def _nexts_differ(a: Branch, b: Branch) -> float:
    """Standard errors of the chi-square statistic of both distributions of next segments."""
    pairs = [(a.nexts.get(k, 0), b.nexts.get(k, 0)) for k in {**a.nexts, **b.nexts}]
    pairs.append((a.n - sum(x for x, _ in pairs), b.n - sum(y for _, y in pairs)))
    pairs = [(x, y) for x, y in pairs if x + y > 0]
    free = len(pairs) - 1
    if not free:
        return 0.0
    share, other = math.sqrt(b.n / a.n), math.sqrt(a.n / b.n)
    square = math.fsum((x * share - y * other) ** 2 / (x + y) for x, y in pairs)
    return ((square / free) ** (1 / 3) - 1 + 2 / (9 * free)) / math.sqrt(2 / (9 * free))


def alike(branches: list[Branch], prior: float) -> list[Branch]:
    """``branches`` merged, the most alike two first, until all that are left differ."""
    def apart(a: Branch, b: Branch) -> float:
        return max(_rates_differ(a, b, prior), _nexts_differ(a, b))

    left = dict(enumerate(sorted(branches, key=lambda x: x.names)))
    gaps = {(i, j): apart(left[i], left[j]) for i in left for j in left if i < j}
    while gaps:
        (i, j), gap = min(gaps.items(), key=lambda x: (x[1], x[0]))
        if gap >= ALIKE:
            break
        left[i] += left.pop(j)
        gaps = {k: g for k, g in gaps.items() if not {i, j} & {*k}}
        gaps |= {(min(i, k), max(i, k)): apart(left[i], left[k]) for k in left if k != i}
    return list(left.values())


def _merged(batches, prior: float):
    """(host, template, final, node) of the siblings that are merged."""
    for batch in batches:
        out = []
        for host, template, kids in zip(*(batch.column(c).to_pylist() for c in ("host", "template", "kids")), strict=True):
            branches = [Branch([k["final"]], k["n"], k["bad"], k["seen"], {x["next"]: x["n"] for x in k["nexts"] or ()}) for k in kids]
            for branch in alike(branches, prior):
                if len(branch.names) > 1:
                    out += [(host, template, name, f"({'|'.join(branch.names)})") for name in branch.names]
        names = ["host", "template", "final", "node"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in range(4)], names=names)


def _level(cur: DataFrame, depth: int, prior: float) -> DataFrame:
    """``cur``, paths of more than ``depth`` segments, with the template one segment longer.

    Where a template has too few URLs, all segments that are left are wildcards.
    """
    digits = F.regexp_replace(F.get("segs", F.lit(depth + 1)), "[0-9]+", "{n}")
    here = cur.withColumn("seg", F.get("segs", F.lit(depth))).withColumn("next", F.coalesce(digits, F.lit("/")))
    sums = [F.sum(c).alias(c) for c in ("n", "bad", "good")]
    fine = here.groupBy("host", "template", "seg", "next").agg(*sums)
    kids = fine.groupBy("host", "template", "seg").agg(*sums)
    # A hot host has a third of the segments: its total is dealt anew, so that AQE can
    # split the join, and the join's rows, so that the next aggregate is not tied to it.
    total = kids.groupBy("host", "template").agg(F.sum("n").alias("all")).repartition("host", "template", "all")
    shape = F.when(F.col("seg").rlike("[0-9]"), F.regexp_replace("seg", "[0-9]+", "{n}")).otherwise(F.lit("*"))
    literal = (F.col("n") >= MIN_SUPPORT) & (F.col("n") >= MIN_SHARE * F.col("all"))
    kids = kids.join(total, ["host", "template"]).repartition("host", "template", "seg").withColumn("label", F.when(literal, F.col("seg")).otherwise(shape))
    labels = kids.groupBy("host", "template", "label").agg(*sums, F.max("all").alias("all"))
    # A shape that is rare as well is any segment.
    rare = (F.col("n") < MIN_SUPPORT) | (F.col("n") < MIN_SHARE * F.col("all"))
    labels = labels.withColumn("final", F.when(rare, F.lit("*")).otherwise(F.col("label")))
    table = store(kids.select("host", "template", "seg", "label", "all").join(labels.select("host", "template", "label", "final"), ["host", "template", "label"]).select("host", "template", "seg", "final", "all"))
    merged = labels.groupBy("host", "template", "final").agg(*sums).withColumn("seen", F.col("bad") + F.col("good"))
    # At most 1 / MIN_SHARE siblings are left, and as many frequent next segments of each.
    several = merged.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kids")).where("kids > 1").select("host", "template")
    merged = store(merged.join(several, ["host", "template"], "left_semi"))
    nexts = fine.select("host", "template", "seg", "next", "n").join(table.select("host", "template", "seg", "final"), ["host", "template", "seg"])
    nexts = nexts.groupBy("host", "template", "final", "next").agg(F.sum("n").alias("n")).repartition("host", "template", "next", "n")
    often = nexts.where(F.col("n") >= MIN_SUPPORT).join(merged.select("host", "template", "final", F.col("n").alias("own")), ["host", "template", "final"]).where(F.col("n") >= MIN_SHARE * F.col("own"))
    often = nexts.join(often.select("host", "template", "next").distinct(), ["host", "template", "next"], "left_semi")
    often = often.groupBy("host", "template", "final").agg(F.collect_list(F.struct("next", "n")).alias("nexts"))
    groups = merged.join(often, ["host", "template", "final"], "left").groupBy("host", "template").agg(F.collect_list(F.struct("final", "n", "bad", "seen", "nexts")).alias("kids"))
    names = groups.mapInArrow(functools.partial(_merged, prior=prior), "host string, template string, final string, node string")
    table = table.join(names, ["host", "template", "final"], "left").select("host", "template", "seg", F.coalesce("node", "final").alias("node"), "all")
    out = cur.withColumn("seg", F.get("segs", F.lit(depth))).join(table, ["host", "template", "seg"])
    few = F.col("all") < MIN_SUPPORT
    longer = F.when(few, F.concat("template", F.repeat(F.lit("/*"), F.size("segs") - depth))).otherwise(F.concat_ws("/", "template", "node"))
    return out.select("host", "path", "segs", "n", "bad", "good", longer.alias("template"), (few | (F.size("segs") <= depth + 1)).alias("ended"))


def templates(urls: DataFrame) -> DataFrame:
    """(host, path, n, bad, good, template) of the distinct paths; ``urls`` has host, path and label (1 bad, 0 good, null)."""
    ship_code(urls.sparkSession)
    cur = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("good"))
    cur = store(cur.withColumn("segs", F.split(F.regexp_replace("path", "^/", ""), "/")).withColumn("template", F.lit("")).withColumn("ended", F.lit(False)))
    prior = prior_of(cur)
    names = ["host", "path", "n", "bad", "good", "template"]
    out, depth = cur.where("false").select(names), 0
    while not cur.where("not ended").isEmpty():
        cur = store(_level(cur.where("not ended").drop("ended"), depth, prior))
        out, depth = out.union(cur.where("ended").select(names)), depth + 1
    return out


def prior_of(tree: DataFrame) -> float:
    """Block rate of all labelled URLs."""
    bad, good = tree.agg(F.sum("bad"), F.sum("good")).first()
    return (bad or 0) / ((bad or 0) + (good or 0) or 1)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, block_rate.

    Null urls and those without ``://`` have an empty host and path. ``rule`` is null where
    none fits; then the verdict is the template's, and allow where it has too few labels.
    Repeated rows count and come out each; a null page_id is carried; an empty table gives
    an empty result. Other columns are not read.
    """
    host, path = host_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("label", F.when(verdict == "block", 1).when(verdict == "allow", 0))
    tree = templates(rows.select("host", "path", "label"))
    prior = prior_of(tree)
    rates = tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rates = rates.select("host", "template", (F.col("bad") + F.col("good")).alias("labels"), ((F.col("bad") + PRIOR_WEIGHT * prior) / (F.col("bad") + F.col("good") + PRIOR_WEIGHT)).alias("block_rate"))
    known = tree.select("host", "path", "template").join(rates, ["host", "template"])
    out = rows.join(known, ["host", "path"], "left")
    by_template = F.when((F.col("labels") >= MIN_LABELLED) & (F.col("block_rate") >= PURITY), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_template).alias("verdict"), "template", "block_rate")
