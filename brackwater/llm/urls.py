"""Operator 3: URL filter rules, and a path-template tree for what no rule fits.

Per host, a path is a walk down a tree of segments. Segments that vary (numbers, hashes, dates, and
children of a node with many rare values) become wildcards, so paths fall into templates. From the deepest
level up, sibling branches are merged whose labelled shares of blocked URLs don't differ significantly,
neither over the whole branch nor at any place below that both have; what is merged is pooled before the next level up.
A template's purity is its labelled share of blocked URLs, smoothed towards the same template under the
domain, that towards the same template anywhere, and that towards the share overall; templates that
are pure enough are rejected. Labels are the verdicts of the rules: the tree carries them over to the
URLs that no rule fits.

Everything is a sum by key with map-side combine over distinct (host, path shape); rows meet their
template in one join. A node keeps at most 20 children besides the wildcard (FAN, RARE), which bounds the
siblings that are compared. Each level is written out, so that no plan holds another level's twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: A rule: verdict, host, path prefix ('/' for all paths).
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: A node's child is variable if the node has at least so many different children and the child at most this share.
FAN, RARE = 20, 0.05
#: Labelled URLs that prior knowledge weighs as much as.
WEIGHT = 5.0
#: Two shares differ if they are so many standard errors apart.
APART = 1.96
#: A template is rejected if its smoothed purity is at least this.
PURITY = 0.8

#: Segments that are variable by their form: numbers (with an extension), dates, long hexadecimal or mixed tokens.
VARIABLE = r"^(?:[0-9]+(?:[-_.][0-9]+)*(?:\.[A-Za-z0-9]{1,5})?|[0-9a-fA-F]{8,}(?:-[0-9a-fA-F]{4,})*|(?=[^/]*[0-9])[A-Za-z0-9_-]{16,})$"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lower-cased, and the path; both '' for null and URLs without '://'."""
    host = F.translate(F.regexp_extract(url, PARTS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. A rule fits its host and all subdomains."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def path_shape(path: Column) -> Column:
    """The path's segments with variable ones as '*'."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s))


def templates(shapes: DataFrame, fan: int = FAN, rare: float = RARE) -> DataFrame:
    """host, shape, n and more to the same with template: the shape with children of busy nodes as wildcards, level by level.

    A node of fewer than `fan` shapes has no busy node at or below it, so its shapes are finished and set aside;
    levels go on while a node holds more, however deep the paths are.
    """
    live, done, level = saved(shapes.withColumn("template", F.lit("")), "level"), [], 0
    while True:
        nodes = live.groupBy("host", "template").agg(F.count("*").alias("shapes")).where(F.col("shapes") >= fan)
        live = live.join(nodes.select("host", "template", F.lit(True).alias("open")), ["host", "template"], "left")
        ends = F.col("open").isNull() | (F.size("shape") <= level)
        rest = F.when(F.size("shape") > level, F.concat(F.lit("/"), F.array_join(F.slice("shape", level + 1, F.size("shape")), "/"))).otherwise("")
        done.append(saved(live.where(ends).withColumn("template", F.concat("template", rest)).drop("open"), "finished"))
        live, level = live.where(~ends).drop("open"), level + 1
        if live.isEmpty():
            break
        out = live.withColumn("segment", F.element_at("shape", level))
        child = out.groupBy("host", "template", "segment").agg(F.sum("n").alias("own"))
        node = child.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("own").alias("all"))
        busy = child.join(node.where(F.col("children") >= fan), ["host", "template"]).where(F.col("own") <= rare * F.col("all"))
        wild = busy.select("host", "template", "segment", F.lit(True).alias("wild"))
        part = F.concat(F.lit("/"), F.when(F.col("wild"), "*").otherwise(F.col("segment")))
        out = out.join(wild, ["host", "template", "segment"], "left").withColumn("template", F.concat("template", part)).drop("wild", "segment")
        live = saved(out, "level")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _differ(n: Column, bad: Column, other_n: Column, other_bad: Column, apart: float) -> Column:
    """Whether two shares are significantly apart (two proportions, pooled error)."""
    p = (bad + other_bad) / (n + other_n)
    return F.abs(bad / n - other_bad / other_n) > apart * F.sqrt(p * (1 - p) * (1 / n + 1 / other_n))


def merged_branches(own: DataFrame, apart: float = APART) -> DataFrame:
    """host, template, labelled and blocked counts to the same with branch: the path of the branch that the template's was merged into, or its own.

    At each level, from the deepest up, a node's children by labelled URLs (ties by name): a child that is unlike all
    before it stands for itself, any other joins the first of those that it is like. Children without labels
    and wildcards join none. Branches below are known by the names they were merged under, and their counts are pooled.
    Where a template has no other beside it any more, nothing merges: levels begin at the deepest that two share.
    """
    segments = F.filter(F.split("template", "/"), lambda s: s != "")
    by_host = Window.partitionBy("host").orderBy("segments")

    def shared(other: Column) -> Column:
        same = F.zip_with("segments", other, lambda a, b: a.eqNullSafe(b))
        return F.coalesce(F.array_position(same, F.lit(False)) - 1, F.lit(0))

    out = own.withColumn("segments", segments)
    keep = F.least(F.greatest(shared(F.lag("segments").over(by_host)), shared(F.lead("segments").over(by_host))) + 1, F.size("segments")).cast("int")
    out = out.withColumn("keep", keep)
    tail = F.when(F.size("segments") > F.col("keep"), F.concat(F.lit("/"), F.array_join(F.slice("segments", F.col("keep") + 1, F.size("segments")), "/"))).otherwise("")
    out = saved(out.withColumn("branch", tail).withColumn("segments", F.slice("segments", F.lit(1), F.col("keep"))).drop("keep"), "branches")
    deepest = out.agg(F.coalesce(F.max(F.size("segments")), F.lit(0))).first()[0]
    at = ["host", "prefix", "segment"]
    for level in range(deepest, 0, -1):
        out = out.withColumn("segment", F.try_element_at("segments", F.lit(level))).withColumn("prefix", F.concat_ws("/", F.slice("segments", 1, level - 1)))
        places = out.where("segment <> '*'").groupBy(*at, F.col("branch").alias("below")).agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("bad"))
        wholes = places.groupBy(*at).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n > 0")
        wholes = wholes.select(*at, F.lit("=").alias("below"), "n", "bad", F.col("n").alias("size"))  # no place below is called '='
        rows = places.where("n > 0").join(wholes.select(*at, "size"), at).unionByName(wholes)
        first, then = rows.alias("a"), rows.alias("b")
        before = (F.col("b.size") > F.col("a.size")) | ((F.col("b.size") == F.col("a.size")) & (F.col("b.segment") < F.col("a.segment")))
        same_place = (F.col("a.host") == F.col("b.host")) & (F.col("a.prefix") == F.col("b.prefix")) & (F.col("a.below") == F.col("b.below"))
        pairs = first.join(then, same_place & before).select(
            "a.host", "a.prefix", "a.segment", F.col("b.segment").alias("root"), F.col("b.size").alias("size"),
            _differ(F.col("a.n"), F.col("a.bad"), F.col("b.n"), F.col("b.bad"), apart).alias("differ"),
        )
        alike = pairs.groupBy(*at, "root", "size").agg(F.max("differ").alias("differ")).where("not differ").drop("differ")
        joined = alike.select("host", "prefix", F.col("segment").alias("root")).distinct()
        roots = alike.join(joined, ["host", "prefix", "root"], "left_anti").groupBy(*at).agg(F.min(F.struct(-F.col("size"), F.col("root").alias("root"))).alias("best"))
        name = F.when(F.col("segment").isNull(), F.col("branch")).otherwise(F.concat(F.lit("/"), F.coalesce("best.root", "segment"), F.col("branch")))
        out = saved(out.join(roots, at, "left").withColumn("branch", name).drop("best", "prefix", "segment"), "branches")
    return out.drop("segments")


def _smoothed(bad: Column, n: Column, prior: Column, weight: float) -> Column:
    return (bad + prior * weight) / (n + weight)


def template_purity(counted: DataFrame, weight: float = WEIGHT, apart: float = APART) -> DataFrame:
    """host, template, labelled and blocked counts to host, template, branch (merged or own) and purity."""
    own = counted.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    marked = merged_branches(own, apart)
    sums = marked.groupBy("host", "branch").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("bad"))
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    both = marked.withColumn("domain", domain)
    near = both.groupBy("domain", "template").agg(F.sum("labelled").alias("near_n"), F.sum("blocked").alias("near_bad"))
    far = both.groupBy("template").agg(F.sum("labelled").alias("far_n"), F.sum("blocked").alias("far_bad"))
    overall = both.agg(F.sum("labelled").alias("all_n"), F.sum("blocked").alias("all_bad")).first()
    base = float(overall["all_bad"] or 0) / overall["all_n"] if overall["all_n"] else 0.0
    p_far = _smoothed(F.col("far_bad"), F.col("far_n"), F.lit(base), weight)
    p_near = _smoothed(F.col("near_bad"), F.col("near_n"), p_far, weight)
    joined = both.join(sums, ["host", "branch"]).join(near, ["domain", "template"]).join(far, "template")
    return joined.select("host", "template", "branch", _smoothed(F.col("bad"), F.col("n"), p_near, weight).alias("purity"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url", purity: float = PURITY) -> DataFrame:
    """Judge every URL: by the longest rule that fits, else by its template.

    Returns a row per row: id_col, host, path, rule (null if none fits), verdict ('allow' or 'block'),
    template and purity (of the tree; null where the table has no other rows to learn from). Null URLs
    and those without '://' have an empty host and path, fit no rule, and are judged by the template of
    such. Paths may have any number of segments. Null ids and repeated rows give a row each. No rows: no rows. Other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("shape", path_shape(F.col("path")))
    shapes = rows.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count("hit").alias("labelled"), F.sum(F.when(F.col("hit.verdict") == "block", 1).otherwise(0)).alias("blocked")
    )
    placed = saved(templates(saved(shapes, "shapes")), "templates")
    judged = template_purity(placed)
    by_shape = placed.select("host", "shape", "template").join(judged.select("host", "template", "purity"), ["host", "template"])
    out = rows.join(by_shape, ["host", "shape"], "left")
    own = F.when(F.col("purity") >= purity, "block").otherwise("allow")
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", own).alias("verdict"), "template", "purity"
    )
