"""Secret scan over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. A pair of blob and rule version is scanned
once: pairs that the ledger holds are skipped, and of several paths with one blob a single copy is read. The
findings are joined back to all paths. Everything is column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shardloom.session import as_written, discard


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; those whose ``group`` is below ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds, in their order. A run of hex digits, or of what may follow AKIA, is always matched whole, so
#: that its least length can stand in the pattern.
BASE_RULES = (
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


_LAID = "array<struct<rule: int, pos: int, gap: int, size: int, judged: int>>"


def _matches(rule: Rule, place: int) -> Column:
    """Per match of a rule: its place in the list of rules, its number in the text, the characters since the match
    before, its length, and the length of the judged group. Laid out only for texts that the rule occurs in."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    found = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("whole"), judged.alias("judged"))
    laid = F.transform(F.slice(found, 1, F.size(whole)), lambda m, i: F.struct(
        F.lit(place).alias("rule"), i.alias("pos"), F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("size"),
        F.length(m["judged"]).alias("judged")))
    return F.when(F.array_contains("rule_names", rule.name) & text.rlike(rule.pattern), laid).otherwise(F.array().cast(_LAID))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(blob, kind, start, end)`` for ``(blob, text, rule_names)``; code points, end exclusive.

    All rules look at a text in one pass over the table. The places of matches are running sums over one text and rule.
    """
    each = F.concat(*[_matches(r, i) for i, r in enumerate(rules)])
    found = blobs.select("blob", F.explode(each).alias("m")).select("blob", "m.*")
    upto = Window.partitionBy("blob", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule") + F.lit(1))
    return (
        found.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
        .filter(F.col("judged") >= of([r.least for r in rules]))
        .select("blob", of([r.kind for r in rules]).alias("kind"), (F.col("end") - F.col("size")).alias("start"), "end").distinct()
    )


def scan_versions(docs: DataFrame, ledger: DataFrame | None = None, findings: DataFrame | None = None,
                  rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(versions, ledger, findings)`` after scanning what the ledger does not hold.

    ``versions`` has ``doc_id, blob`` per input row, ``ledger`` the pairs ``blob, rule_name`` scanned so far and
    ``findings`` the spans ``blob, kind, start, end`` of all blobs, earlier ones included. All texts are read twice:
    for their address, and to write one copy of every unseen blob; the rules look at those copies alone, once.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    versions = as_written(rows.select("doc_id", blob_of(F.col("text")).alias("blob")), "versions")
    names = F.array(*[F.lit(r.name) for r in rules])
    # Of the rows of one blob those of the least id, a null id last; ``copies`` says how many they are.
    least = versions.groupBy("blob", "doc_id").agg(F.count(F.lit(1)).alias("copies")).groupBy("blob").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copies")).alias("o"))
    pairs = least.select("blob", F.col("o.doc_id").alias("first_id"), F.col("o.copies").alias("copies"),
                         F.explode(names).alias("rule_name"))
    if ledger is not None:
        pairs = pairs.join(ledger.select("blob", "rule_name"), ["blob", "rule_name"], "left_anti")
    unseen = as_written(pairs.groupBy("blob", "first_id", "copies").agg(
        F.array_sort(F.collect_set("rule_name")).alias("rule_names")), "unseen")
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (blob_of(F.col("text")) == F.col("blob"))
    texts = rows.join(unseen.filter("copies = 1"), same).select("blob", "text", "rule_names")
    repeated = as_written(unseen.filter("copies > 1"), "repeated")
    if not repeated.isEmpty():
        once = rows.join(repeated, same).groupBy("blob", "rule_names").agg(F.any_value("text").alias("text"))
        texts = texts.unionByName(once)
    # Written, so that no rule looks at a blob that the ledger holds, and all of them share one pass.
    copies = as_written(texts, "unseen-texts")
    fresh = as_written(scan_blobs(copies, rules), "findings")
    discard(copies)
    scanned = unseen.select("blob", F.explode("rule_names").alias("rule_name"))
    return (versions, scanned if ledger is None else ledger.select("blob", "rule_name").unionByName(scanned),
            fresh if findings is None else findings.select("blob", "kind", "start", "end").unionByName(fresh))


def secret_spans(versions: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES,
                 base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Findings joined back to every version: ``doc_id``, ``n_<kind>`` per base kind, ``base_sha256`` and ``spans``.

    Spans read ``kind:start:end``, ordered by start, then kind as listed, and are joined by commas; a version
    without findings has zero counts and empty lists. Null and empty texts share the blob of the empty text;
    repeated rows repeat; other columns are not read; an empty table gives an empty result.
    """
    place = reduce(lambda c, i: c.when(F.col("kind") == rules[i].kind, i), range(1, len(rules)),
                   F.when(F.col("kind") == rules[0].kind, 0))
    lists = findings.withColumn("place", place).filter(F.col("place").isNotNull()).groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "end", "kind"))).alias("found"))
    show = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    of = lambda kind: lambda x: x["kind"] == kind
    kinds = [r.kind for r in base]
    per_blob = lists.select(
        "blob", *[F.size(F.filter("found", of(k))).cast("long").alias(f"n_{k}") for k in kinds],
        F.array_join(F.transform(F.filter("found", lambda x: x["kind"].isin(*kinds)), show), ",").alias("base"),
        F.array_join(F.transform("found", show), ",").alias("spans"))
    # Written, so that the join exchanges both sides and a hot blob can be split.
    joined = versions.join(as_written(per_blob, "spans"), "blob", "left")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))
