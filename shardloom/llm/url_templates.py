"""URL filter by a tree of path templates per host.

Paths are cut into segments. Segments that look variable - numbers, hexadecimal runs, dates - become wildcards
by their form, and a branch point with many rare children becomes one wildcard by its counts. Templates carry
labelled counts; sibling branches whose shares of bad pages do not differ significantly are merged. The bad share of a
template is smoothed from the general to the particular: along the domains that its host lies in, then along the
branches of the host's tree down to the template itself, so that a branch without labels has the share of what it lies
in. Templates whose share reaches a threshold are rejected. Everything is column expressions, and nothing depends on how
deep the paths are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import LOWER, UPPER, with_few
from shardloom.session import as_written

#: A branch point is variable from so many distinct children on, with fewer pages than this for each.
FAN, SUPPORT = 16, 4
#: Siblings merge while their bad share lies within so many standard errors of the branch.
MERGE_Z = 2.0
#: Bad share where nothing is known, and how many labelled pages the share of the next wider level weighs as much as.
PRIOR, SMOOTHING = 0.2, 8.0
REJECT = 0.5


@dataclass(frozen=True)
class UrlRule:
    """A rule fits its host and all subdomains if the path starts with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """Place of the longest fitting rule in ``rules``, or null."""
    out = F.lit(None).cast("int")
    for i, r in sorted(enumerate(rules), key=lambda x: len(x[1].name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def _of_rule(values: list, r: Column) -> Column:
    """The rule's entry of ``values``, null where no rule fits."""
    out = F.lit(None)
    for i, v in enumerate(values):
        out = F.when(r == i, F.lit(v)).otherwise(out)
    return out


def segments_of(path: Column) -> Column:
    """The path's segments with variable forms as wildcards."""
    form = lambda s: (
        F.when(s.rlike(r"^[0-9]+$"), F.lit("{n}"))
        .when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit("{date}"))
        .when(s.rlike(r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("{n}."), F.substring_index(s, ".", -1)))
        .when(s.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), F.lit("{x}"))
        .otherwise(s))
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), form)


def _literal(segment: Column) -> Column:
    return (segment != "*") & ~segment.startswith("{")


def _above(tpl: Column, n: Column) -> Column:
    """A short name of the branch of the first ``n`` segments."""
    return F.md5(F.concat_ws("/", n.cast("string"), F.slice(tpl, F.lit(1), n)))


def template_tree(pages: DataFrame, fan: int = FAN, support: int = SUPPORT) -> DataFrame:
    """``(shape, host, segs, tpl, labelled, bad)``: the template of every distinct shape, with its counts, written.

    ``pages`` has ``host, segs, bad``: 1, 0 or null where not labelled. A round turns the children of all variable
    branch points, at any depth, into wildcards; that lets branches meet, so rounds follow until none is variable: one
    more than such points lie below one another.
    """
    shapes = as_written(pages.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
    ).withColumn("tpl", F.col("segs")).withColumn("shape", F.monotonically_increasing_id()), "shapes")
    while True:
        steps = F.transform("tpl", lambda x, i: F.struct(i.alias("level"), x.alias("child"), _above(F.col("tpl"), i).alias("above")))
        nodes = shapes.select("shape", "host", "n", F.explode(F.filter(steps, lambda x: _literal(x["child"]))).alias("x")).select(
            "shape", "host", "n", "x.*")
        wide = as_written(
            nodes.groupBy("host", "above", "child").agg(F.sum("n").alias("n")).groupBy("host", "above").agg(
                F.count(F.lit(1)).alias("c"), F.sum("n").alias("pages"))
            .filter((F.col("c") >= fan) & (F.col("pages") < F.col("c") * support)).select("host", "above"), "variable")
        if wide.isEmpty():
            return shapes
        found = as_written(with_few(nodes.select("shape", "host", "above", "level"), wide, ["host", "above"]).groupBy(
            F.col("shape").alias("of")).agg(F.collect_set("level").alias("levels")), "levels")
        name = lambda x, i: F.when(_literal(x) & F.array_contains("levels", i), F.lit("*")).otherwise(x)
        shapes = as_written(shapes.join(found, F.col("shape") == F.col("of"), "left").withColumn(
            "tpl", F.when(F.col("levels").isNull(), F.col("tpl")).otherwise(F.transform("tpl", name))).drop("of", "levels"), "shapes")


def _shares(rows: DataFrame, key: str, start: Column, smoothing: float) -> DataFrame:
    """``(key, share)``: the counts ``n, b`` of a key's levels taken in from the widest on, from ``start`` (by key)."""
    steps = F.array_sort(F.collect_list(F.struct("level", "n", "b")))
    take = lambda s, x: (x["b"] + smoothing * s) / (x["n"] + smoothing)
    return rows.groupBy(key, start.alias("start")).agg(steps.alias("steps")).select(
        key, F.aggregate("steps", F.col("start"), take).alias("share"))


def domain_shares(tree: DataFrame, prior: float = PRIOR, smoothing: float = SMOOTHING) -> DataFrame:
    """``(host, share)`` of hosts that lie in a domain with labels: the domains from the last label of the name on."""
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    parts = F.split("host", r"\.")
    own = hosts.select("host", "n", "b", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat_ws(".", F.slice(parts, -i, i)))).alias("level", "domain"))
    counts = as_written(own.filter("n > 0").groupBy("domain").agg(F.sum("n").alias("n"), F.sum("b").alias("b")), "domains")
    return as_written(_shares(with_few(own.select("host", "level", "domain"), counts, ["domain"]), "host", F.lit(prior), smoothing), "host-shares")


def branch_counts(tree: DataFrame, z: float = MERGE_Z) -> DataFrame:
    """``(host, node, n, b)``: the counts that stand for every labelled branch, written.

    A branch whose share lies within ``z`` standard errors of that of all branches beside it is merged with the others
    that do and has the counts of them all; any other has its own.
    """
    labelled = tree.filter("labelled > 0").groupBy("host", "tpl").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    steps = F.transform("tpl", lambda x, i: F.struct(_above(F.col("tpl"), i + 1).alias("node"), _above(F.col("tpl"), i).alias("above")))
    nodes = as_written(labelled.select("host", "n", "b", F.explode(steps).alias("x")).groupBy("host", "x.node", "x.above").agg(
        F.sum("n").alias("n"), F.sum("b").alias("b")), "branches")
    beside = as_written(nodes.groupBy("host", "above").agg((F.sum("b") / F.sum("n")).alias("p")), "levels")
    p = F.col("p")
    judged = as_written(with_few(nodes, beside, ["host", "above"]).withColumn(
        "apart", F.abs(F.col("b") / F.col("n") - p) > z * F.sqrt(p * (1 - p) / F.col("n") + 1e-9)), "judged")
    merged = as_written(judged.filter("not apart").groupBy("host", "above").agg(F.sum("n").alias("m_n"), F.sum("b").alias("m_b")), "merged")
    both = with_few(judged, merged, ["host", "above"], how="left")
    either = lambda own, all_: F.when(F.col("apart"), F.col(own)).otherwise(F.col(all_)).alias(own)
    return as_written(both.select("host", "node", either("n", "m_n"), either("b", "m_b")), "branch-counts")


def template_shares(tree: DataFrame, prior: float = PRIOR, smoothing: float = SMOOTHING) -> DataFrame:
    """``(host, segs, tpl, share)``: the smoothed bad share of every shape's template, written.

    Written, so that the join of the pages to it exchanges both sides and a hot host can be split.
    """
    known = with_few(tree.select("shape", "host", "segs", "tpl"), domain_shares(tree, prior, smoothing), ["host"], how="left").select(
        "shape", "host", "segs", "tpl", F.coalesce("share", F.lit(prior)).alias("base"))
    known = as_written(known, "bases")
    nodes = known.select("shape", "host", "base", F.posexplode(F.transform("tpl", lambda x, i: _above(F.col("tpl"), i + 1))).alias("level", "node"))
    own = _shares(with_few(nodes, branch_counts(tree), ["host", "node"]), "shape", F.col("base"), smoothing).withColumnRenamed("shape", "of")
    return as_written(known.join(as_written(own, "shape-shares"), F.col("shape") == F.col("of"), "left").select(
        "host", "segs", "tpl", F.coalesce("share", "base").alias("share")), "shares")


def url_verdicts(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, labels: DataFrame | None = None,
                 id_col: str = "page_id", url_col: str = "url", reject: float = REJECT) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, template, bad_share``.

    The longest fitting rule decides; otherwise the page's template is blocked when its bad share is at least
    ``reject``. Pages are labelled by ``labels`` (``page_id``, ``bad`` 0 or 1) or else by the rules that fit them.
    A null url or one without ``://`` has an empty host and path; rows with a repeated id repeat; of several
    labels of one page the worst counts; other columns are not read; an empty table gives an empty result. Paths of
    any depth are judged by all of their segments. Only distinct shapes of one host meet in a shuffle, after counting
    where the pages lie.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.select("*", segments_of(F.col("path")).alias("segs"), rule_of(F.col("host"), F.col("path"), rules).alias("r"))
    if labels is None:
        rows = rows.withColumn("bad", _of_rule([int(r.verdict == "block") for r in rules], F.col("r")).cast("int"))
    else:
        known = labels.groupBy(F.col("page_id").alias("__page")).agg(F.max(F.col("bad").cast("int")).alias("bad"))
        rows = rows.join(known, F.col("page_id") == F.col("__page"), "left").drop("__page")
    rows = as_written(rows, "urls")
    shapes = template_shares(template_tree(rows))
    return rows.join(shapes, ["host", "segs"]).select(
        "page_id", "host", "path", _of_rule([r.name for r in rules], F.col("r")).cast("string").alias("rule"),
        F.coalesce(_of_rule([r.verdict for r in rules], F.col("r")), F.when(F.col("share") >= reject, "block").otherwise("allow")).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("tpl", "/")).alias("template"), F.col("share").alias("bad_share"))
