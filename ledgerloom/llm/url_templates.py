"""URL filtering by rules and by path templates.

Every host has a tree of path segments.  Numbers and hashes in a segment become
wildcards, a node with many different children becomes one wildcard, and
children whose continuations and labels are distributed as those of all children
together are merged.  A template (a path through the tree) is rejected if the
smoothed share of bad ones among its labelled urls is high.  A host's template is
smoothed towards the paths of its shapes on all hosts, and those towards a half, so
that hosts without labels are judged by the others.  Labels are what the rules say, or
given ones.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed

#: Different children from which on a node is a wildcard.
MANY = 16
#: Jensen-Shannon divergence up to which children are merged.
ALIKE = 0.02
#: A template is bad from this smoothed purity on; each prior counts as so many labelled urls.
PURITY = 0.8
PRIOR_WEIGHT = 4.0

Rules = list[tuple[str, str]]
RULES: Rules = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits, as (rule, verdict); NULL if none. For rule lists written by hand."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def canonical(path: Column) -> Column:
    """A path with hashes and numbers as wildcards."""
    return F.regexp_replace(F.regexp_replace(path, r"(?i)\b(?=[0-9a-f-]*\d)[0-9a-f-]{16,}\b", "{h}"), r"\d+", "{n}")


def _shape(segment: Column) -> Column:
    """What kind of segment: one of few."""
    kind = F.regexp_replace(F.coalesce(segment, F.lit("$")), r"[\p{L}_]+", "a")
    return F.substring(F.regexp_replace(kind, r"(a[^a.{}$]*)+", "a"), 1, 16)


def templates(paths: DataFrame, many: int = MANY, alike: float = ALIKE) -> DataFrame:
    """``paths``: ``host, shape, n, bad, good`` per distinct canonical path; adds ``template``.

    Works level by level until no path has a further segment.  A path alone in
    its node has one child on every further level, so its rest is named at once.
    """
    segments = F.split(F.col("shape"), "/")
    tree = paths.select(
        "host", "shape", "n", "bad", "good", segments.alias("segments"), F.lit("").alias("template"), (F.size(segments) > 1).alias("open")
    )
    label = F.when(F.col("bad") > F.col("good"), "bad").when(F.col("good") > 0, "good").otherwise("none")
    level = 0
    while tree.where("open").limit(1).count():
        level += 1
        here = F.when(F.col("open"), F.get(F.col("segments"), F.lit(level)))
        tree = tree.withColumn("segment", here).withColumn(
            "follows", F.concat_ws("|", _shape(F.get(F.col("segments"), F.lit(level + 1))), label)
        )
        node = ["host", "template"]
        inner = tree.where(F.col("segment").isNotNull())
        seen = inner.groupBy(*node, "segment", "follows").agg(F.sum("n").alias("c"), F.count("*").alias("paths"))
        child = seen.groupBy(*node, "segment").agg(
            F.sum("c").alias("total"), F.count("*").alias("kinds"), F.sum("paths").alias("held")
        )
        whole = seen.groupBy(*node, "follows").agg(F.sum("c").alias("all"))
        size = child.groupBy(*node).agg(F.sum("total").alias("mass"), F.count("*").alias("children"))
        p, q = F.col("c") / F.col("total"), F.col("all") / F.col("mass")
        m = (p + q) / 2
        far = (
            seen.join(child, [*node, "segment"])
            .join(whole, [*node, "follows"])
            .join(size, node)
            .groupBy(*node, "segment")
            .agg(
                (F.sum(p * F.log(p / m) / 2 + q * F.log(q / m) / 2 - q * F.log(F.lit(2.0)) / 2) + F.log(F.lit(2.0)) / 2).alias("far"),
                F.max("total").alias("total"),
                F.max("kinds").alias("kinds"),
                F.max("children").alias("children"),
                F.max("held").alias("held"),
            )
        )
        # Few urls differ from the whole by chance alone.
        near = F.col("far") <= alike + F.col("kinds") / (4 * F.col("total"))
        becomes = (
            F.when(F.col("children") > many, "*").when(near & (F.col("children") > 1), "+").otherwise(F.col("segment"))
        )
        # A segment that reads as a wildcard shares its node with what became one.
        alone = (F.col("held") == 1) & (becomes == F.col("segment")) & ~F.col("segment").isin("*", "+")
        named = far.select(*node, "segment", becomes.alias("becomes"), alone.alias("alone"))
        further = F.size("segments") > level + 1
        rest = F.array_join(F.slice("segments", level + 2, F.greatest(F.size("segments") - level - 1, F.lit(0))), "/")
        tail = F.when(F.col("alone") & further, F.concat(F.lit("/"), rest)).otherwise("")
        tree = checkpointed(
            tree.join(named, [*node, "segment"], "left")
            .withColumn("template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), F.coalesce("becomes", "segment"), tail)))
            .withColumn("open", F.col("segment").isNotNull() & ~F.coalesce("alone", F.lit(False)) & further)
            .drop("segment", "follows", "becomes", "alone")
        )
    return tree.select("host", "shape", "n", "bad", "good", "template")


def url_filter(pages: DataFrame, rules: Rules | None = None, labels: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for each row of ``pages`` (``page_id, url``).

    The verdict is that of the longest fitting rule, else of the url's template:
    ``block`` if its smoothed purity reaches ``PURITY``, else ``allow``: with a host's b bad
    and g good labelled urls of the template, and B and G of the same canonical paths on all
    hosts, (b + 4 s) / (b + g + 4) where s = (B + 2) / (B + G + 4).
    ``labels``: ``page_id, bad`` to judge templates by; by default the rules'
    verdicts.  A NULL url, or one without ``://``, has an empty host and path;
    rows with NULL or repeated ids are judged each; other columns are ignored.
    """
    rules = RULES if rules is None else rules
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", canonical(F.col("path")))
    marked = rows.withColumn("bad", F.col("found.verdict") == "block")
    if labels is not None:
        known = labels.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max(F.col("bad").cast("boolean")).alias("bad"))
        marked = rows.join(known, "page_id", "left")
    paths = marked.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count_if(F.col("bad")).alias("bad"), F.count_if(~F.col("bad")).alias("good")
    )
    tree = templates(checkpointed(paths))
    # A shape that many hosts have is one row here and many there: the adaptive engine splits those.
    pooled = tree.groupBy("shape").agg(F.sum("bad").alias("all_b"), F.sum("good").alias("all_g"))
    rated = tree.join(pooled, "shape").groupBy("host", "template").agg(
        *[F.sum(c).alias(n) for c, n in (("bad", "b"), ("good", "g"), ("all_b", "all_b"), ("all_g", "all_g"))]
    )
    share = (F.col("all_b") + PRIOR_WEIGHT / 2) / (F.col("all_b") + F.col("all_g") + PRIOR_WEIGHT)
    purity = (F.col("b") + PRIOR_WEIGHT * share) / (F.col("b") + F.col("g") + PRIOR_WEIGHT)
    judged = tree.select("host", "shape", "template").join(
        rated.select("host", "template", purity.alias("purity")), ["host", "template"]
    )
    verdict = F.when(F.col("purity") >= PURITY, "block").otherwise("allow")
    return rows.join(judged, ["host", "shape"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", verdict).alias("verdict"),
        "template",
        "purity",
    )
