"""URL filter by a tree of path templates.

Paths are cut into segments; digit runs become ``#``. Level by level, per host and prefix, a segment stays literal if it
holds enough of the prefix's URLs, all others become ``*``: so a node has at most ``1 / LEAST_SHARE`` literal children
and a wildcard. Leaves below one parent whose label shares do not differ significantly are merged. A template is rejected
when its purity, the share of good ones among its labelled URLs smoothed towards its host's and that towards the
overall share, is too low; a branch without any label is never rejected. The tree is built on counts per distinct path shape, never on single URLs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import LOWER, UPPER, lookup
from siteplan.session import stage

DEPTH = 6  # levels; what lies deeper is one segment
LEAST_SHARE, LEAST_URLS = 0.02, 5
SIMILAR = 1.64  # standard errors
STRENGTH = 10.0
LEAST_PURITY = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for a null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1)


def shape_of(path: Column, depth: int = DEPTH) -> Column:
    """Segments with digit runs as ``#``, long hexadecimal runs as ``~``; the last one holds all deeper ones."""
    plain = F.regexp_replace(F.regexp_replace(path, r"(?i)(?<![0-9a-f-])\b(?=[a-f-]*+[0-9])(?=[0-9-]*+[a-f])[0-9a-f-]{12,}\b", "~"), r"[0-9]+", "#")
    parts = F.split(plain, "/", -1)
    return F.when(F.size(parts) <= depth, parts).otherwise(
        F.concat(F.slice(parts, 1, depth - 1), F.array(F.array_join(F.slice(parts, depth, F.size(parts)), "/"))))


def rule_for(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits; nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def templates(urls: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(host, shape, template, parent, n, good, bad) for every distinct shape of ``urls`` (host, path, bad 0/1/null)."""
    nodes = stage(urls.select("host", shape_of(F.col("path"), depth).alias("shape"), "bad").groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("bad") == 0, 1)).alias("good"), F.count(F.when(F.col("bad") == 1, 1)).alias("bad"))
        .withColumn("template", F.lit("")), "url_nodes")
    for k in range(depth):
        here = nodes.withColumn("_segment", F.when(F.size("shape") > k, F.col("shape")[k]))
        size = here.groupBy("host", "template", "_segment").agg(F.sum("n").alias("_n"))
        total = size.groupBy("host", "template").agg(F.sum("_n").alias("_total"))
        literal = (lookup(size, total, ["host", "template"], [F.col("_segment")])
                   .filter((F.col("_n") >= LEAST_URLS) & (F.col("_n") >= LEAST_SHARE * F.col("_total")) & F.col("_segment").isNotNull())
                   .select("host", "template", "_segment", F.lit(True).alias("_literal")))
        marked = lookup(here, literal, ["host", "template", "_segment"], [F.xxhash64("shape")])
        step = F.when(F.col("_segment").isNull(), F.col("template")).otherwise(
            F.concat("template", F.lit("/" if k else ""), F.when(F.col("_literal"), F.col("_segment")).otherwise(F.lit("*"))))
        parent = F.when(F.col("_segment").isNull(), F.col("parent") if k else F.lit("")).otherwise(F.col("template"))
        nodes = stage(marked.select("host", "shape", "n", "good", "bad", step.alias("template"), parent.alias("parent")), "url_nodes")
    return nodes


def merge_similar(leaves: DataFrame) -> DataFrame:
    """Add ``branch``: leaves of one parent, ordered by their bad share, join the branch before them unless they differ.

    A parent has at most ``1 / LEAST_SHARE`` leaves and a wildcard, so a group is small.
    """
    def merge(x: pd.DataFrame) -> pd.DataFrame:
        share = x["bad"] / (x["good"] + x["bad"]).clip(lower=1)
        x = x.assign(_share=share).sort_values(["_share", "template"], kind="stable")
        branch, good, bad, out = 0, 0, 0, []
        for g, b in zip(x["good"], x["bad"], strict=True):
            if out and good + bad and g + b:
                p = (bad + b + 1) / (good + bad + g + b + 2)
                error = math.sqrt(p * (1 - p) * (1 / (good + bad) + 1 / (g + b)))
                if abs(b / (g + b) - bad / (good + bad)) > SIMILAR * error:
                    branch, good, bad = branch + 1, 0, 0
            good, bad = good + g, bad + b
            out.append(branch)
        return x.assign(branch=out).drop(columns="_share")

    return leaves.groupBy("host", "parent").applyInPandas(merge, "host string, parent string, template string, good long, bad long, branch int")


def judged(urls: DataFrame, depth: int = DEPTH, least_purity: float = LEAST_PURITY) -> DataFrame:
    """(host, shape, template, branch, purity, rejected) for every distinct shape of ``urls`` (host, path, bad 0/1/null)."""
    nodes = templates(urls, depth)
    leaves = nodes.groupBy("host", "parent", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    merged = stage(merge_similar(leaves), "url_leaves")
    total = merged.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    overall = (total[0] + 1) / (total[0] + total[1] + 2)
    good = merged.groupBy("host").agg(F.sum("good").alias("_g"), F.sum(F.col("good") + F.col("bad")).alias("_l"))
    hosts = good.select("host", ((F.col("_g") + STRENGTH * overall) / (F.col("_l") + STRENGTH)).alias("_host"))
    branches = merged.groupBy("host", "parent", "branch").agg(F.sum("good").alias("_g"), F.sum(F.col("good") + F.col("bad")).alias("_l"))
    pure = lookup(branches, hosts, ["host"], [F.xxhash64("parent", "branch")]).withColumn(
        "purity", (F.col("_g") + STRENGTH * F.col("_host")) / (F.col("_l") + STRENGTH)).withColumn("rejected", (F.col("purity") < least_purity) & (F.col("_l") > 0))
    by_leaf = merged.select("host", "parent", "template", "branch").join(
        pure.select("host", "parent", "branch", "purity", "rejected"), ["host", "parent", "branch"])
    return lookup(nodes.select("host", "shape", "parent", "template"), by_leaf, ["host", "parent", "template"], [F.xxhash64("shape")]).drop("parent")


def filtered(pages: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", depth: int = DEPTH,
             least_purity: float = LEAST_PURITY) -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) of every row of ``pages`` (key, url, bad 0/1/null).

    The verdict is the longest fitting rule's, else block for a rejected template and allow otherwise. Null urls and urls
    without ``://`` have an empty host and path, which is a template like any other. Repeated rows each get a row.
    """
    rows = stage(pages.select(F.col(key), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "bad"), "urls")
    name, verdict = rule_for(rules, F.col("host"), F.col("path"))
    tree = stage(judged(rows, depth, least_purity), "url_tree")
    found = lookup(rows.withColumn("shape", shape_of(F.col("path"), depth)), tree, ["host", "shape"], [F.xxhash64("path", key)])
    return found.select(key, "host", "path", name.alias("rule"),
                        F.coalesce(verdict, F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "template", "purity")
