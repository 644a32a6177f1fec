"""Templates against a plain recursive tree, and jobs that do not grow with the deepest path."""

import math
import random

import pytest
from pyspark.sql import functions as F

from farebox.llm import url_templates as U


def plain_templates(rows):
    """Template of each (segments, n, good, bad) of one host, child by child from the root."""
    out = {}

    def apart(good, bad, all_good, all_bad):
        n, m = good + bad, all_good + all_bad - good - bad
        pooled = all_bad / (n + m) if n + m else 0
        if not (n and m and 0 < pooled < 1):
            return False
        return abs(bad / n - (all_bad - bad) / m) > 1.96 * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))

    def grow(template, level, members):
        for row in members:
            if len(row[0]) == level:
                out[row[0]] = template
        members = [r for r in members if len(r[0]) > level]
        children = {}
        for row in members:
            children.setdefault(row[0][level], []).append(row)
        sums = {c: [sum(r[k] for r in rs) for k in (1, 2, 3)] for c, rs in children.items()}
        few = sum(s[0] < U.FEW_PAGES for s in sums.values())
        branches = {}
        for child, (n, good, bad) in sums.items():
            if n < U.FEW_PAGES and few > U.MANY_CHILDREN:
                branch = "*"
            elif apart(good, bad, sum(s[1] for s in sums.values()), sum(s[2] for s in sums.values())):
                branch = child
            else:
                branch = "+"
            branches.setdefault(branch, []).extend(children[child])
        for branch, rs in branches.items():
            grow(f"{template}/{branch}", level + 1, rs)

    grow("", 0, rows)
    return out


def random_rows(seed):
    draw = random.Random(seed)
    rows = {}
    for _ in range(draw.choice([5, 60, 300])):
        depth = draw.choice([0, 1, 2, 3, 7, 12])
        path = tuple(draw.choice(["a", "b", "c"] if k % 3 else ["x", *(f"s{j}" for j in range(50))]) for k in range(depth))
        if draw.random() < 0.4:
            path = ("long",) * 9 + path
        bad = draw.random() < (0.9 if "b" in path else 0.1)
        labelled = draw.choice([0, 1, 5, 40])
        n, good, wrong = rows.get(path, (0, 0, 0))
        rows[path] = (n + labelled + 1, good + labelled * (not bad), wrong + labelled * bad)
    return [(path, *counts) for path, counts in rows.items()]


def ours(spark, rows):
    counts = spark.createDataFrame(
        [("h", list(p), n, g, b) for p, n, g, b in rows],
        "host string, segments array<string>, n long, good long, bad long")
    return {tuple(r.segments): r.template for r in U.templates(counts).collect()}


@pytest.mark.parametrize("seed", range(6))
def test_templates_are_the_plain_tree(spark, seed):
    rows = random_rows(seed)
    assert ours(spark, rows) == plain_templates(rows)


@pytest.mark.parametrize("trap", ["one", "growing", "forked"])
def test_deep_urls_add_few_jobs(spark, trap):
    """One path of 2,000 segments; one that was followed step by step; two of 600 that fork at the end."""
    rows = [(("a", "b"), 3, 1, 1), (("a", "c"), 9, 6, 0)]
    loop = ("cal", "next") * (1_000 if trap == "one" else 300)
    rows += {"one": [(loop, 1, 1, 0)], "growing": [(loop[:k], 1, 0, k % 2) for k in range(1, 400, 7)],
             "forked": [(loop + ("x",), 50, 50, 0), (loop + ("y",), 50, 0, 50)]}[trap]
    sc = spark.sparkContext
    sc.setJobGroup(f"urls-{trap}", "urls")
    try:
        found = ours(spark, rows)
        jobs = len(sc.statusTracker().getJobIdsForGroup(f"urls-{trap}"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert found == plain_templates(rows) if trap != "one" else found[loop].count("/") == 2_000
    assert jobs < 60


def test_odd_pages(spark):
    """Null ids and urls, rows that repeat, two labels of one page, ids of too many digits, other columns."""
    urls = ["http://h.info/p/7", "http://h.info/p/7", None, "", "http://h.info/p/" + "1" * 25, "http://h.info/p/00007.html"]
    pages = spark.createDataFrame(
        [(k if k else None, u) for k, u in enumerate(urls)], "page_id long, url string").withColumns(
        {c: F.lit("x") for c in ("host", "segments", "template", "shown", "good")})
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    found = U.filter_urls(pages, labels).collect()
    assert len(found) == 6 and all(r.verdict in ("allow", "block") for r in found)
    assert len({(r.verdict, r.purity) for r in found if r.path.endswith("/7")}) == 1
    # The lower one of two labels counts: all that is known of the host is bad.
    assert {r.verdict for r in found if r.path.startswith("/p/")} == {"block"}
    assert U.filter_urls(pages.limit(0), labels).count() == 0
