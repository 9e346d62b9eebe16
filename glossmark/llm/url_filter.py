"""URL verdicts by rules and, where none fits, by a path-template tree learned from those that rules judge. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmark.llm.common import join_groups, written

#: A rule's verdict, host and path prefix.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))


@dataclass(frozen=True)
class TreeLimits:
    #: A node whose children are so many, and so large a share of its urls, has variable segments there.
    min_children: int = 8
    variable_share: float = 0.5
    #: Branches with so many labelled urls each merge if their shares blocked differ by at most so many standard errors (two-proportion test).
    min_labelled: int = 5
    z: float = 2.0
    #: A template is rejected if (blocked + 1) / (labelled + 2) is at least this.
    purity: float = 0.9


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host with A-Z lower-cased, after the first `://` up to `/`, `?`, `#` or the end; the path then up to `?`, `#` or the end."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, shape, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, shape, 2)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: its host is the url's or a parent of it, its path a prefix of the url's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, domain, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        rule, verdict = F.when(fits, domain + prefix).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def segment_class(segment: Column) -> Column:
    """Segments that vary by their form, by the kind of it: numbers, numbers with a suffix, long hexadecimal, dates."""
    return (
        F.when(segment.rlike(r"^[0-9]+$"), "{n}")
        .when(segment.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "{date}")
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.concat(F.lit("{n}."), F.regexp_extract(segment, r"\.(.*)$", 1)))
        .when(segment.rlike(r"^[0-9a-fA-F-]{16,}$"), "{hex}")
        .otherwise(segment)
    )


def shapes(urls: DataFrame) -> DataFrame:
    """urls with shape: host and path, segments that vary by form generalised, empty ones left out."""
    parts = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), segment_class)
    return urls.withColumn("shape", F.concat_ws("/", F.array("host"), parts))


def _merged(children: DataFrame, limits: TreeLimits) -> DataFrame:
    """children (child, node, step, n, labelled, bad) with the name each one's step has in the template.

    A node with very many children for its urls has variable segments: all are `*`. Of its other children, those with
    enough labels are ordered by their share blocked, and neighbours in that order merge if the test finds them alike: what such
    links connect is one branch, `~1`, `~2` and so on. The rest stand alone. The order is one of distinct label counts, so
    children that have the same are one row of it, however many they are."""
    firm = F.col("labelled") >= limits.min_labelled
    whole = children.groupBy("node").agg(F.count(F.lit(1)).alias("children"), F.sum("n").alias("urls"))
    variable = (F.col("children") >= limits.min_children) & (F.col("children") >= limits.variable_share * F.col("urls"))
    kinds = children.where(firm).groupBy("node", "labelled", "bad").agg(F.count(F.lit(1)).alias("alike"))
    share = F.col("bad") / F.col("labelled")
    order = W.partitionBy("node").orderBy(share, "labelled")
    n, bad, m, worse = F.lag("labelled").over(order), F.lag("bad").over(order), F.col("labelled"), F.col("bad")
    pooled = (bad + worse) / (n + m)
    apart = F.abs(worse / m - bad / n) > limits.z * F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    chained = kinds.select("node", "labelled", "bad", "alike", F.sum(F.when(apart, 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0)).alias("group"))
    branches = chained.withColumn("members", F.sum("alike").over(W.partitionBy("node", "group"))).where("members > 1").select("node", "labelled", "bad", (F.col("group") + 1).cast("string").alias("group"))
    named = children.join(branches, ["node", "labelled", "bad"], "left").join(whole.where(variable).select("node", F.lit(True).alias("variable")), "node", "left")
    return named.withColumn("name", F.when(F.col("variable"), "*").when(F.col("group").isNotNull(), F.concat(F.lit("~"), "group")).otherwise(F.col("step"))).select("child", "rows", "name")


def tree(urls: DataFrame, limits: TreeLimits = TreeLimits()) -> DataFrame:
    """(shape, host, template, n, labelled, blocked) of urls (host, path, blocked: 1, 0 or null).

    The tree is grown on distinct shapes, with sums of their urls, from each host's root. A round takes each node that holds
    rests that differ down to where they part, which is where the least and the greatest of them part, and names the branches
    there (_merged). A shape alone in its node, or with others of the same rest, is done, as nothing below could change its template; so there are as many
    rounds as branchings above one another, whatever the paths' depth, and a round works on what is left. Each is a table. A
    node with a large share of the shapes is joined by broadcast, and no task gets all its rows."""
    counted = shapes(urls).groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("blocked").alias("labelled"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"))
    rest = F.slice(F.split("shape", "/"), 2, 1 << 30)
    left = written(counted.select("*", rest.alias("rest"), F.col("host").alias("node")), "shapes")
    done = []
    while total := left.count():
        nodes = left.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("rest").alias("least"), F.max("rest").alias("greatest"))
        same = F.transform(F.zip_with("least", "greatest", lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False)))
        nodes = written(nodes.select("node", "rows", F.when(F.col("least") != F.col("greatest"), F.array_position(same, False).cast("int") - 1).alias("fork")), "nodes")
        placed = join_groups(left, nodes, "node", "rows", total).drop("rows")
        down = F.concat_ws("/", F.array("node"), F.expr("slice(rest, 1, coalesce(fork, size(rest)))"))
        ends = F.col("fork").isNull() | (F.size("rest") == F.col("fork"))
        placed = placed.withColumn("node", down).withColumn("done", ends).withColumn("step", F.expr("get(rest, fork)"))
        placed = placed.withColumn("rest", F.expr("slice(rest, fork + 2, 1073741824)")).withColumn("child", F.concat_ws("/", "node", "step")).drop("fork")
        placed = written(placed, "placed")
        done.append(placed.where("done").select("shape", "host", F.substr("node", F.length("host") + 1).alias("template"), "n", "labelled", "blocked"))
        going = placed.where("not done").drop("done")
        children = written(going.groupBy("child", "node", "step").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("bad"), F.count(F.lit(1)).alias("rows")), "children")
        going = join_groups(going, written(_merged(children, limits), "names"), "child", "rows", total).drop("rows")
        left = written(going.withColumn("node", F.concat("node", F.lit("/"), "name")).drop("step", "child", "name"), "left")
    whole = counted.where("false").select("shape", "host", F.lit("").alias("template"), "n", "labelled", "blocked")
    for some in done:
        whole = whole.unionByName(some)
    return whole


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, limits: TreeLimits = TreeLimits()) -> DataFrame:
    """(id_col, host, path, rule, verdict, template) of each row.

    The longest rule that fits decides. Where none does, the url's template does: labels are the verdicts of rules; a template
    whose smoothed share of blocked among labelled urls reaches the limit is rejected, so its other urls are blocked, and all
    else is allowed. A null url, and one without `://`, has an empty host and path and is allowed. Rows that repeat an id or a
    url each count. An empty table gives no rows. Other columns, whatever their names, are not read."""
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = written(shapes(rows.select("*", rule.alias("rule"), F.when(verdict == "block", 1).when(verdict == "allow", 0).alias("blocked"))), "urls")
    grown = written(tree(rows, limits), "tree")
    purity = grown.groupBy("host", "template").agg(((F.sum("blocked") + 1) / (F.sum("labelled") + 2) >= limits.purity).alias("rejected"))
    told = written(grown.join(purity, ["host", "template"]).select("shape", "template", "rejected", "n"), "told")
    judged = join_groups(rows, told, "shape", "n", rows.count())
    bad = F.coalesce(F.col("blocked") == 1, F.col("rejected"))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.when(bad, "block").otherwise("allow").alias("verdict"), "template")
