"""URL filter by a path-template tree.

A url is ``(host, path)``: the host stands between the first ``://`` and the
next ``/``, ``?``, ``#`` or the end, the path from there up to ``?``, ``#`` or
the end.  Curated rules decide what they fit (longest rule first); the urls
they decide are the labelled examples of the method, which decides the rest:

1. per host, the path's segments form a tree.  A segment with a digit is
   variable and becomes a wildcard that keeps its file extension;
2. level by level, the children of a node become one wildcard if there are
   more than ``fan_out`` of them and most of them were seen once (slugs);
3. sibling branches that are statistically similar are merged: the same set
   of templates below, and label rates whose confidence intervals (Wilson)
   lie on the same side of the purity limit.  Branches without examples
   merge only with each other, and a branch with fewer than ``min_labelled``
   examples stays by itself, so labels never spread to a branch without any;
4. a template is rejected if its smoothed share of blocked examples,
   ``(blocked + 1) / (labelled + 2)``, reaches ``purity``.

The tree is built on the distinct generalised paths of a host with their
counts, not on urls; every level is one aggregate and one join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

WILD = "*"


def host_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; null urls and such
    without ``://`` give two empty strings."""
    u = F.col(url)
    at = F.coalesce(F.instr(u, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    raw = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"(?s)^([^?#]*)", 1)
    return host, path


def rule_column(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path-prefix``) that fits a url, else null.  A
    rule fits its host and all subdomains, if the path starts with its path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _template(path: Column, depth: int) -> Column:
    """The first ``depth`` segments with variable ones generalised; what is
    deeper is one segment ``**``."""
    parts = F.split(path, "/")
    body = F.slice(parts, 2, depth)
    general = F.transform(body, lambda s: F.when(
        s.rlike("[0-9]"), F.concat(F.lit(WILD), F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1))).otherwise(s))
    return F.when(F.size(parts) - 1 > depth, F.concat(general, F.array(F.lit("**")))).otherwise(general)


def _side(blocked: Column, labelled: Column, purity: float, min_labelled: int) -> Column:
    """-1, 0 or 1: the Wilson interval (95 %) of the blocked share lies below,
    around or above the purity limit; null without enough examples."""
    z2 = 1.96 ** 2
    n, p = labelled, blocked / labelled
    mid, half = p + z2 / (2 * n), 1.96 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    lo, hi = (mid - half) / (1 + z2 / n), (mid + half) / (1 + z2 / n)
    return F.when(labelled < min_labelled, None).when(lo >= purity, 1).when(hi < purity, -1).otherwise(0)


def path_templates(paths: DataFrame, depth: int = 5, fan_out: int = 50, slug_share: float = 0.5,
                   purity: float = 0.8, min_labelled: int = 5) -> DataFrame:
    """``(host, segments, template, labelled, blocked, score, rejected)`` for
    every generalised path of ``paths`` (``host, segments, n, labelled,
    blocked``)."""
    cur = paths.withColumn("final", F.col("segments"))
    for d in range(depth):                        # slugs, from the root down
        prefix = F.slice("final", 1, d)
        here = F.get(F.col("final"), F.lit(d))
        kids = (cur.filter(F.size("final") > d).groupBy("host", prefix.alias("prefix"), here.alias("kid")).agg(F.sum("n").alias("n"))
                   .groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("kids"), F.sum((F.col("n") == 1).cast("int")).alias("once"))
                   .filter((F.col("kids") > fan_out) & (F.col("once") >= slug_share * F.col("kids"))).select("host", "prefix")
                   .withColumn("slugs", F.lit(True)))
        cur = cur.withColumn("prefix", prefix).join(kids, ["host", "prefix"], "left")
        wild = F.concat(prefix, F.array(F.lit(WILD)), F.slice("final", d + 2, depth + 1))
        cur = cur.withColumn("final", F.when(F.col("slugs") & (F.size("final") > d), wild).otherwise(F.col("final"))).drop("prefix", "slugs")
        # a table per level: with no slugs the joins vanish and the levels' expressions would multiply
        cur = materialize(cur, "templates")
    # merge similar branches: the children of a host's root and what lies below them
    branch = F.get(F.col("final"), F.lit(0))
    below = F.array_join(F.slice("final", 2, depth + 1), "/")
    shape = (cur.select("host", branch.alias("branch"), below.alias("below"), "labelled", "blocked")
                .groupBy("host", "branch", "below").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
                .groupBy("host", "branch").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"),
                                               F.bit_xor(F.xxhash64("below")).alias("below"), F.count(F.lit(1)).alias("count"))
                .withColumn("side", _side(F.col("blocked"), F.col("labelled"), purity, min_labelled))
                .withColumn("class", F.xxhash64("below", "count", F.when(F.col("side").isNotNull(), F.col("side").cast("string"))
                                                .when(F.col("labelled") == 0, "none").otherwise(F.concat(F.lit("/"), "branch")))))
    names = shape.groupBy("host", "class").agg(F.min("branch").alias("lead"), F.count(F.lit(1)).alias("merged"))
    lead = shape.join(names, ["host", "class"]).select("host", "branch", "lead", "merged")
    cur = (cur.withColumn("branch", branch)
              .join(lead.withColumnRenamed("host", "h").withColumnRenamed("branch", "b"),
                    F.col("host").eqNullSafe(F.col("h")) & F.col("branch").eqNullSafe(F.col("b")), "left").drop("h", "b"))
    head = F.when(F.col("merged") > 1, F.concat(F.lit("{"), "lead", F.lit(",...}"))).otherwise(F.col("branch"))
    template = F.concat(F.lit("/"), F.array_join(F.concat(F.array(F.coalesce(head, F.lit(""))), F.slice("final", 2, depth + 1)), "/"))
    cur = cur.withColumn("template", template)
    score = cur.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    score = score.select("host", "template", F.col("l").alias("labelled"), F.col("b").alias("blocked"),
                         ((F.col("b") + 1) / (F.col("l") + 2)).alias("score"))
    return (cur.select("host", "segments", "template").join(score, ["host", "template"])
               .withColumn("rejected", F.col("score") >= purity))


def judge_urls(pages: DataFrame, rules: dict[str, str], page_id: str = "page_id", url: str = "url",
               depth: int = 5, fan_out: int = 50, slug_share: float = 0.5, purity: float = 0.8,
               min_labelled: int = 5) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, score)`` for every row
    of ``pages``; ``rules`` maps ``host/path-prefix`` to ``allow`` or ``block``.

    The verdict is the rule's where one fits, else ``block`` if the url's
    template is rejected, else ``allow``.  Null urls and urls without ``://``
    have an empty host and path and no rule, and are judged like the
    templates of one host without examples (allow).  Repeated rows are judged
    alike; null ids are kept.  Other columns are not read.
    """
    host, path = host_path("_url")
    rows = (pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
                 .select("page_id", host.alias("host"), path.alias("path"))
                 .withColumn("rule", rule_column(F.col("host"), F.col("path"), rules))
                 .withColumn("segments", _template(F.col("path"), depth)))
    blocked = reduce(lambda a, r: a | (F.col("rule") == r), [r for r, v in rules.items() if v == "block"], F.lit(False))
    paths = rows.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"), F.count("rule").alias("labelled"),
        F.sum(F.coalesce(blocked, F.lit(False)).cast("int")).alias("blocked"))
    templates = materialize(path_templates(materialize(paths, "paths"), depth, fan_out, slug_share, purity, min_labelled), "judged")
    given = F.lit(None).cast("string")
    for r, v in rules.items():
        given = F.when(F.col("rule") == r, F.lit(v)).otherwise(given)
    out = rows.join(templates.select("host", "segments", "template", "score", "rejected"), ["host", "segments"], "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce(given, F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                      "template", "score")
