"""Operator 1: URL filters from path-template trees.

Rules (block or allow, by host suffix and path prefix) decide the URLs that
they fit and label the tree for all others.  Per host, paths form a tree of
segments:

1. numbers inside a segment become ``0``, and the children of a node that are
   many and mostly distinct become one wildcard ``*``;
2. of the children of a node that have ``MERGE_MIN`` URLs or more, the heaviest
   is a head, and those whose continuations and labels do not differ
   significantly (Hoeffding's bound) from it merge with it to ``{name}``; so on
   with the heaviest of the others, until none is left;
3. a template is rejected if its smoothed share of blocked URLs among labelled
   ones, (blocked + 1) / (labelled + 2), reaches ``PURITY``.

Counts per host and template are combined before every shuffle, so a hot host
costs one row per task and template.  The tree has all segments of each path; a
round of jobs goes one branching deeper, past segments that all paths share.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower
case; path: then up to ``?``, ``#`` or the end.  A null URL and one without
``://`` have empty host and path, no template, and are allowed.  A URL of any
length is judged whole; of rules of equal length that fit the first by name
counts.  Repeated rows each count and each get a verdict; an empty table gives an empty result; input
columns named as an output column give way to it.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common
from linkloom.llm.components import rejoined
from linkloom.llm.exact_dedup import LOWER, UPPER

#: A node's children are variable if so many are distinct, and so large a share.
VARIABLE_CHILDREN, VARIABLE_SHARE = 8, 0.3
MERGE_MIN, SIGNIFICANCE = 10, 0.05
PURITY = 0.9

_BOUND = math.sqrt(0.5 * math.log(2 / SIGNIFICANCE))


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule that fits, or null.  ``com/en/`` fits host ``com``, its
    subdomains, and paths that start with ``/en/``."""

    def fits(rule: str) -> Column:
        name, _, rest = rule.partition("/")
        own = (host == name) | host.endswith("." + name) if name else F.lit(True)
        return own & path.startswith("/" + rest) if "/" in rule else own

    found = [F.when(fits(r), F.lit(r)) for r in sorted(rules, key=lambda r: (-len(r), r))]
    return F.coalesce(*found, F.lit(None).cast("string"))


def _generalise(paths: DataFrame) -> DataFrame:
    """Children ``s`` of variable nodes become a wildcard."""
    kids = paths.groupBy("host", "p", "s").agg(F.sum("n").alias("n"))
    variable = (
        kids.groupBy("host", "p")
        .agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("n"))
        .filter((F.col("kids") >= VARIABLE_CHILDREN) & (F.col("kids") >= VARIABLE_SHARE * F.col("n")))
        .select("host", "p", F.lit(True).alias("variable"))
    )
    wild = F.col("variable").isNotNull() & (F.col("s") != "")
    return rejoined(paths, variable, ["host", "p"], "left").withColumn("s", F.when(wild, "/*").otherwise(F.col("s"))).drop("variable")


def _alike(branches: dict[str, dict]) -> dict[str, str]:
    """The head of every branch of a node that merges, heads included.

    Heaviest first, a branch joins the heaviest head that it does not differ
    from, or becomes a head.  ``branches`` have ``n``, ``blocked``, ``allowed``,
    ``alone`` (their largest share of a kind that no other branch has) and
    ``kinds`` (URLs by kind that others have too)."""
    heads: list[str] = []
    sizes, shares = array("d"), {c: array("d") for c in ("blocked", "allowed")}
    showing: dict[int, tuple[array, array]] = {}  # heads by kind, and the kind's share of each
    found: dict[str, str] = {}
    for name in sorted(branches, key=lambda s: (branches[s]["n"], s), reverse=True):
        own = branches[name]
        n, rates = own["n"], {kind: k / own["n"] for kind, k in own["kinds"].items()}
        bound = _BOUND * (1 / math.sqrt(n) + 1 / np.sqrt(np.array(sizes)))
        shown = np.zeros(len(heads))
        for kind in rates:
            if kind in showing:
                shown[np.array(showing[kind][0])] += np.array(showing[kind][1])
        near = (own["alone"] < bound) & (1 - shown < bound)
        for c, of in shares.items():
            near &= np.abs(own[c] / n - np.array(of)) < bound
        for at in np.flatnonzero(near).tolist():
            head = branches[heads[at]]
            if all(abs(r - head["kinds"].get(kind, 0) / head["n"]) < bound[at] for kind, r in rates.items()):
                found[name] = found[heads[at]] = heads[at]
                break
        else:
            for kind, r in rates.items():
                ids, values = showing.setdefault(kind, (array("q"), array("d")))
                ids.append(len(heads))
                values.append(r)
            heads.append(name)
            sizes.append(n)
            for c, of in shares.items():
                of.append(own[c] / n)
    return found


def _named(node: pa.Table) -> pa.Table:
    """``host, p, s, head`` of one node's branches that merge."""
    branches: dict[str, dict] = {}
    for r in node.to_pylist():
        own = branches.setdefault(r["s"], {**r, "kinds": {}})
        if r["kind"] is not None:
            own["kinds"][r["kind"]] = r["k"]
    found = _alike(branches)
    host, p = node["host"][0].as_py(), node["p"][0].as_py()
    columns = [[host] * len(found), [p] * len(found), list(found), list(found.values())]
    return pa.table([pa.array(c, pa.string()) for c in columns], ["host", "p", "s", "head"])


def _merge(paths: DataFrame) -> DataFrame:
    """Children ``s`` that do not differ from one another merge.  A node's
    branches and the continuations that two of them have are one task's."""
    node, counts = ["host", "p"], ("n", "blocked", "allowed")
    kinds = paths.groupBy(*node, "s", F.coalesce(F.get("tail", F.lit(1)), F.lit("")).alias("kind")).agg(
        *(F.sum(c).alias(c) for c in counts))
    branch = kinds.groupBy(*node, "s").agg(*(F.sum(c).alias(c) for c in counts)).filter(
        (F.col("n") >= MERGE_MIN) & (F.col("s") != ""))
    several = branch.groupBy(*node).agg(F.count(F.lit(1)).alias("branches")).filter("branches > 1").select(*node)
    branch = branch.join(several, node)
    own = kinds.select(*node, "s", "kind", F.col("n").alias("k")).join(branch.select(*node, "s"), [*node, "s"])
    having = own.groupBy(*node, "kind").agg(F.count(F.lit(1)).alias("having"))
    own = rejoined(own, having, [*node, "kind"])
    shared = own.filter("having > 1").select(*node, "s", "kind", "k")
    alone = own.filter("having = 1").groupBy(*node, "s").agg(F.max("k").alias("alone"))
    rows = (
        branch.join(alone, [*node, "s"], "left")
        .join(shared, [*node, "s"], "left")
        .select(*node, "s", *counts, (F.coalesce("alone", F.lit(0)) / F.col("n")).alias("alone"), "kind", "k")
    )
    named = rows.groupBy(*node).applyInArrow(_named, "host string, p string, s string, head string")
    group = F.concat(F.lit("/{"), F.substring("head", 2, 10**6), F.lit("}"))
    return rejoined(paths, named, [*node, "s"], "left").withColumn("s", F.coalesce(group, F.col("s"))).drop("head")


def _skip(paths: DataFrame) -> DataFrame:
    """Past the segments that all paths of a node share: a lone child neither
    becomes a wildcard nor merges.  ``open`` where paths of the node go on apart."""
    ends = paths.groupBy("host", "p").agg(F.min("tail").alias("lo"), F.max("tail").alias("hi"))
    same = F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b))
    ends = ends.select("host", "p", (F.array_position(same, False) - 1).cast("int").alias("shared"))
    alike = F.when(F.col("shared") < 0, F.size("tail")).otherwise(F.col("shared"))
    return rejoined(paths, ends, ["host", "p"]).select(
        "host", "raw", F.concat("p", F.array_join(F.slice("tail", F.lit(1), alike), "")).alias("p"),
        F.slice("tail", alike + 1, F.greatest(F.size("tail"), F.lit(1))).alias("tail"),
        "n", "blocked", "allowed", (F.col("shared") >= 0).alias("open"))


def templates(paths: DataFrame) -> DataFrame:
    """``host, raw, template`` and the template's counts and purity, from
    ``host, raw, n, blocked, allowed``."""
    segments = F.split("raw", "/")
    tail = F.transform(F.slice(segments, 2, F.size(segments)), lambda s: F.concat(F.lit("/"), s))
    left = paths.withColumn("p", F.lit("")).withColumn("tail", tail)
    ready = []
    while True:
        now = common.written(_skip(left), "urls")
        ready.append(now.filter("not open"))
        left = now.filter("open").drop("open")
        if left.isEmpty():
            break
        left = left.withColumn("s", F.coalesce(F.get("tail", F.lit(0)), F.lit("")))
        left = _merge(_generalise(left))
        left = left.withColumn("p", F.concat("p", "s")).withColumn("tail", F.slice("tail", 2, F.greatest(F.size("tail"), F.lit(1)))).drop("s")
        left = common.written(left, "urls")
    now = reduce(DataFrame.unionByName, ready)
    pure = now.groupBy("host", "p").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")).withColumn(
        "purity", (F.col("blocked") + 1) / (F.col("blocked") + F.col("allowed") + 2))
    return rejoined(now.select("host", "raw", "p"), pure, ["host", "p"]).select("host", "raw", F.col("p").alias("template"), "purity")


def judge_urls(
    pages: DataFrame,
    rules: Mapping[str, str],
    url_col: str = "url",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``keep`` (default: all columns) with ``host``, ``path``, ``rule``,
    ``verdict`` (the rule's, else the template's), ``template`` and ``purity``."""
    made = ["host", "path", "rule", "verdict", "template", "purity"]
    kept = common.without(pages.columns if keep is None else keep, made)
    url = common.quoted(url_col).cast("string")
    parsed = pages.select(*(common.quoted(c).alias(f"__k{i}") for i, c in enumerate(kept)),
                          host_of(url).alias("host"), path_of(url).alias("path"))
    by_rule = F.coalesce(*(F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()), F.lit(None).cast("string"))
    rows = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("by_rule", by_rule)
    rows = rows.withColumn("raw", F.regexp_replace("path", "[0-9]+", "0"))
    paths = (
        rows.filter("host <> ''")
        .groupBy("host", "raw")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("by_rule") == "block").alias("blocked"),
            F.count_if(F.col("by_rule") == "allow").alias("allowed"),
        )
    )
    judged = F.when(F.col("purity") >= PURITY, "block").otherwise("allow")
    return rejoined(rows, templates(paths), ["host", "raw"], "left").select(
        *(F.col(f"__k{i}").alias(c) for i, c in enumerate(kept)),
        "host", "path", "rule", F.coalesce("by_rule", judged).alias("verdict"), "template", "purity",
    )
