"""URL filter: host and path rules first, then a tree of path templates with labelled purity.

Paths are taken apart at slashes into the branches of a tree per host. Runs of digits are wildcards
at once. Level by level, where many children of a node hold few pages each, these children are one
variable child. Of the others, however large they are, those whose share of bad pages does not
differ from that of their siblings (two proportions, 95 %) are merged into one branch. This goes on
until no path has a further segment. What is left are templates. A chain of only children is gone
through in one step, and a branch with so few paths and labels that nothing below can differ is done
at once, so rounds are as many as there are real forks, however deep a path is. A template's purity
is its share of good pages, smoothed towards its host's, which is smoothed towards the share of all
pages; templates of a purity below one half are blocked.

A page's label is the quality label of the document whose id ends its path, the lower one if that has
several; an id has 18 digits at most. Pages without one count
for the form of the tree only. Counting is by distinct host and template with partial sums where the
pages are read; the tree is built from these counts. Null and odd urls have empty host and path,
which is a template like any other. Rows that repeat are judged alike; without labels all is allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import staged

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# A node's children of fewer pages than this are one variable child if there are more than so many.
MANY_CHILDREN, FEW_PAGES = 32, 8
SMOOTHING = 5.0
LEAST_PURITY = 0.5
_95_PERCENT = 1.96


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def segments_of(path: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(path, r"\d+", "*"), "/"), lambda s: s != "")


def _tests(good: Column, bad: Column, all_good: Column, all_bad: Column) -> Column:
    """Whether a child's share of bad pages differs from that of its siblings."""
    n, m = good + bad, all_good + all_bad - good - bad
    share, others = bad / n, (all_bad - bad) / m
    pooled = all_bad / (n + m)
    return F.when((n > 0) & (m > 0) & (pooled > 0) & (pooled < 1), F.abs(share - others) > _95_PERCENT * F.sqrt(
        pooled * (1 - pooled) * (1 / F.greatest(n, F.lit(1)) + 1 / F.greatest(m, F.lit(1))))).otherwise(F.lit(False))


def _plus(count: Column) -> Column:
    return F.repeat(F.lit("/+"), count)


def _folded(tree: DataFrame) -> DataFrame:
    """The tree with all nodes moved down to where they fork, or to their ends if nothing can differ.

    All that reaches a depth of a trunk has one segment there, so it is one branch whatever its counts.
    Rows that leave the trunk differ from the greatest row, in the order of arrays, at some place; the
    trunk ends at the first of these. Rows that are a beginning of the greatest one end on the trunk.
    """
    node, rest = ["host", "template"], F.col("rest")
    tops = tree.groupBy(*node).agg(
        F.max("rest").alias("top"), F.count(F.lit(1)).alias("rows"), F.sum("good").alias("all_good"),
        F.sum("bad").alias("all_bad"))
    # Too few rows for a variable child; of three labels or equal ones no two shares differ.
    alike = (F.col("all_good") == 0) | (F.col("all_bad") == 0) | (F.col("all_good") + F.col("all_bad") <= 3)
    rows = tree.join(tops.withColumn("simple", (F.col("rows") <= MANY_CHILDREN) & alike), node)
    same = F.zip_with("rest", F.slice("top", F.lit(1), F.size("rest")), lambda a, b: a.eqNullSafe(b))
    off = F.array_position(same, False) - 1
    rows = rows.withColumn("off", F.when(off >= 0, off))
    trunks = rows.groupBy(*node).agg(F.min("off").alias("trunk"))
    rows = rows.join(trunks, node)
    steps = F.when(F.col("simple"), F.size(rest)).otherwise(
        F.least(F.coalesce("trunk", F.size(rest).cast("long")), F.size(rest).cast("long"))).cast("int")
    return rows.withColumn("steps", steps).select(
        "host", "segments", "n", "good", "bad", F.concat("template", _plus(F.col("steps"))).alias("template"),
        F.slice("rest", F.col("steps") + 1, F.size("rest")).alias("rest"))


def templates(counts: DataFrame) -> DataFrame:
    """``host``, ``segments`` and the ``template`` they fall under, from counts per host and segments."""
    tree = counts.select("*", F.lit("").cast("string").alias("template"), F.col("segments").alias("rest"))
    node, ended = ["host", "template"], []
    while True:
        tree = staged(_folded(tree), "url-folded")
        ended.append(tree.where(F.size("rest") == 0).drop("rest"))
        tree = tree.where(F.size("rest") > 0)
        if tree.isEmpty():
            return reduce(DataFrame.unionByName, ended)
        child = F.col("rest")[0]
        children = staged(tree.groupBy(*node, child.alias("child")).agg(
            *[F.sum(c).alias(c) for c in ("n", "good", "bad")]), "url-children")
        few = F.col("n") < FEW_PAGES
        siblings = children.groupBy(*node).agg(
            F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"), F.count_if(few).alias("all_few"))
        children = children.join(siblings, node)
        many = few & (F.col("all_few") > MANY_CHILDREN)
        apart = _tests(F.col("good"), F.col("bad"), F.col("all_good"), F.col("all_bad"))
        # "*": variable segment; "+": children like each other; else the child by itself, marked if
        # it is written like one of the two.
        own = F.when(F.col("child").rlike(r"^=*[*+]$"), F.concat(F.lit("="), "child")).otherwise(F.col("child"))
        branch = F.when(many, F.lit("*")).when(apart, own).otherwise(F.lit("+"))
        named = children.select(*node, "child", branch.alias("branch"))
        tree = tree.withColumn("child", child).join(named, [*node, "child"]).select(
            "host", "segments", "n", "good", "bad", F.concat("template", F.lit("/"), "branch").alias("template"),
            F.slice("rest", F.lit(2), F.size("rest")).alias("rest"))


def judged(tree: DataFrame) -> DataFrame:
    """Templates with ``purity`` and ``verdict``."""
    everywhere = tree.agg(((F.sum("good") + 1) / (F.sum("good") + F.sum("bad") + 1)).alias("prior"))
    prior = everywhere.first()["prior"]
    prior = 1.0 if prior is None else float(prior)

    def smoothed(towards: Column) -> Column:
        return (F.col("good") + SMOOTHING * towards) / (F.col("good") + F.col("bad") + SMOOTHING)

    def totals(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))

    # Sums are pre-aggregated, so no task holds all rows of a host.
    by_template = staged(totals(tree, "host", "template"), "url-sums")
    hosts = totals(by_template, "host").select("host", smoothed(F.lit(prior)).alias("host_purity"))
    scored = by_template.join(hosts, "host").withColumn("purity", smoothed(F.col("host_purity")))
    scored = scored.select("host", "template", "purity", F.when(
        F.col("purity") < LEAST_PURITY, F.lit("block")).otherwise(F.lit("allow")).alias("method_verdict"))
    return tree.join(scored, ["host", "template"])


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the template with its purity."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("segments", segments_of(F.col("path")))
    shown = F.try_to_number(F.regexp_extract("path", r"(?<!\d)(\d{1,18})(?:\.\w+)?/?$", 1), F.lit("9" * 18)).cast("long")
    known = labels.select(F.col("doc_id").cast("long").alias("shown"), F.col("quality").cast("int").alias("quality"))
    known = known.where("shown is not null").groupBy("shown").agg(F.min("quality").alias("quality"))
    counted = rows.withColumn("shown", shown).groupBy("host", "segments", "shown").agg(F.count(F.lit(1)).alias("n"))
    counts = counted.join(known, "shown", "left").groupBy("host", "segments").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("quality") == 0, F.col("n")).otherwise(0)).alias("bad"))
    verdicts = staged(judged(templates(staged(counts, "url-counts"))).select(
        "host", "segments", "template", "purity", "method_verdict"), "url-templates")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return rows.join(verdicts, ["host", "segments"], "left").withColumn("_rule", rule).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "method_verdict").alias("verdict"), "template", "purity")
