"""URL filter: prefix rules, and a path-template tree for what they leave open.

Rules (action, host, path) fit a host with all its subdomains and paths with the rule's path in
front; the longest wins, of equal ones the last. Their verdicts, and those of ``labels`` where no rule fits, are the
labels from which the tree learns.

The tree of a domain (the host's last two names) has the host below its root and then the path's
segments, ``DEPTH`` of them; what is deeper is one wildcard. Segments vary, and are one wildcard, if they are numbers or
long hexadecimal ones, or if a node has ``VARIABLE`` different ones or more, and one to two pages or more.
Labelled branches below a node whose share of good pages is that of all of them, by a test of two
standard deviations, are merged: they are one node with their labels summed. A branch without labels belongs to the
merged ones if there are two or more with good labels and bad ones among them; labels that could only be given one way
say nothing of other branches. A template is judged at its deepest node with evidence, and rejected if
its purity, smoothed by pseudo-labels, is below the limit; without evidence it is allowed.

Null urls and urls without ``://`` have an empty host and path; equal urls get equal verdicts, also
very long ones; a repeated page counts each time; an empty table gives an empty result; columns other than page_id and
url are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.scratch import materialize

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
PURITY = 0.1  # least smoothed share of good pages
PSEUDO = 2.0  # pseudo-labels per node, half of them good
DEPTH = 6  # segments of a path that are nodes
VARIABLE = 20  # different segments below a node from which they may be values
DEVIATIONS = 2.0  # of a branch's good labels from its share of all, within which it is like the others
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(action, rule) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<action: string, rule: string>")
    for action, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(action).alias("action"), F.lit(name + prefix).alias("rule"))).otherwise(out)
    return out


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def segments(path: Column) -> Column:
    """The path's segments; numbers and long hexadecimal ones are wildcards, and all beyond ``DEPTH`` is one."""
    general = F.regexp_replace(path, r"[0-9a-f]*[0-9][0-9a-f]{7,}", "*")
    every = F.split(F.regexp_replace(F.regexp_replace(general, r"[0-9]+", "*"), "^/", ""), "/")
    return F.when(F.size(every) > DEPTH, F.concat(F.slice(every, 1, DEPTH), F.array(F.lit("**")))).otherwise(every)


def purity(good: Column, bad: Column) -> Column:
    return (good + PSEUDO / 2) / (good + bad + PSEUDO)


def generalised(counts: DataFrame) -> DataFrame:
    """``counts(domain, given, n, ...)`` with ``node``: the given names with wildcards where they vary.

    Level by level from the root, so that branches that vary above are one when their own names are looked at.
    """
    counts = counts.withColumn("node", F.col("given"))
    for level in range(DEPTH + 1):
        parent = F.slice("node", 1, level)
        named = counts.filter(F.size("node") > level).withColumn("child", F.get("node", F.lit(level)))
        varying = (
            named.groupBy(F.col("domain").alias("_domain"), parent.alias("_parent"))
            .agg(F.count_distinct("child").alias("kinds"), F.sum("n").alias("pages"))
            .filter((F.col("kinds") >= VARIABLE) & (2 * F.col("kinds") >= F.col("pages"))).select("_domain", "_parent")
        )
        same = (F.col("domain") == F.col("_domain")) & (parent == F.col("_parent")) & (F.size("node") > level)
        star = F.concat(parent, F.array(F.lit("*")), F.slice("node", level + 2, DEPTH + 2))
        counts = materialize(
            counts.join(varying, same, "left")
            .withColumn("node", F.when(F.col("_domain").isNotNull(), star).otherwise(F.col("node"))).drop("_domain", "_parent")
        )
    return counts


def template_verdicts(pages: DataFrame) -> DataFrame:
    """(domain, given, node, evidence, rejected) from pages with domain, given (host and segments) and label.

    Templates are counted first; the tree is made from their counts.
    """
    counts = materialize(
        pages.groupBy("domain", "given").agg(
            F.count("*").alias("n"), F.count_if(F.col("label") == "allow").alias("good"), F.count_if(F.col("label") == "block").alias("bad")
        )
    )
    counts = generalised(counts)
    prefixes = counts.select("domain", "given", "good", "bad", F.col("node").alias("full"),
                             F.explode(F.sequence(F.lit(0), F.size("node"))).alias("level"))
    prefixes = prefixes.withColumn("node", F.slice("full", F.lit(1), F.col("level")))
    nodes = prefixes.groupBy("domain", "node").agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).filter("g + b > 0")
    children = nodes.filter("size(node) > 0").withColumn("parent", F.slice("node", F.lit(1), F.size("node") - 1))
    pooled = children.groupBy("domain", "parent").agg((F.sum("g") / F.sum(F.col("g") + F.col("b"))).alias("p"))
    n, p = F.col("g") + F.col("b"), F.col("p")
    like = F.abs(F.col("g") - n * p) <= DEVIATIONS * F.sqrt(n * p * (1 - p)) + 0.5
    tested = materialize(children.join(pooled, ["domain", "parent"]).withColumn("like", like))
    merged = tested.filter("like").groupBy("domain", "parent").agg(
        F.sum("g").alias("mg"), F.sum("b").alias("mb"), F.count("*").alias("branches")
    )
    # What a labelled node says of its own pages, and what it says of branches without labels below it.
    own = tested.join(merged, ["domain", "parent"], "left").select(
        "domain", "node", F.when(F.col("like"), F.col("mg")).otherwise(F.col("g")).alias("g"),
        F.when(F.col("like"), F.col("mb")).otherwise(F.col("b")).alias("b"),
    )
    passed = merged.filter("branches > 1 and mg > 0 and mb > 0").select("domain", F.col("parent").alias("node"), "mg", "mb")
    known = nodes.select("domain", "node").join(own, ["domain", "node"], "left").join(passed, ["domain", "node"], "left")
    deepest = prefixes.join(known, ["domain", "node"]).groupBy("domain", "given", "full").agg(
        F.max(F.struct("level", "g", "b", "mg", "mb")).alias("at")
    )
    whole = F.col("at.level") == F.size("full")
    good, bad = F.when(whole, F.col("at.g")).otherwise(F.col("at.mg")), F.when(whole, F.col("at.b")).otherwise(F.col("at.mb"))
    verdicts = deepest.select("domain", "given", good.isNotNull().alias("evidence"), (purity(good, bad) < PURITY).alias("rejected"))
    return counts.select("domain", "given", "node").join(verdicts, ["domain", "given"], "left").select(
        "domain", "given", "node", F.coalesce("evidence", F.lit(False)).alias("evidence"), F.coalesce("rejected", F.lit(False)).alias("rejected")
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labels: DataFrame | None = None
) -> DataFrame:
    """page_id, host, path, rule, verdict, the page's template and whether the tree had evidence of it.

    ``labels`` (page_id, label: allow or block) are known verdicts of pages that no rule fits; they are learnt from, and the
    pages themselves are judged by the tree. Of several labels of a page the first in the alphabet counts.
    """
    url = F.col("url")
    parsed = (
        pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
        .select(
            "page_id", "host", "path", F.col("_rule.action").alias("action"), F.col("_rule.rule").alias("rule"),
            domain_of(F.col("host")).alias("domain"), F.concat(F.array("host"), segments(F.col("path"))).alias("given"),
        )
    )
    learnt = parsed.withColumn("label", F.col("action"))
    if labels is not None:
        one = labels.groupBy(F.col("page_id").alias("_page")).agg(F.min("label").alias("_label"))
        learnt = parsed.join(one, F.col("page_id") == F.col("_page"), "left").withColumn("label", F.coalesce("action", "_label"))
    verdicts = materialize(template_verdicts(learnt))
    judged = parsed.join(verdicts, ["domain", "given"], "left")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("action", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        F.concat(F.lit("/"), F.array_join(F.slice("node", 2, DEPTH + 1), "/")).alias("template"),
        (F.col("rule").isNull() & F.col("evidence")).alias("by_evidence"),
    )
