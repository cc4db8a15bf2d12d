"""Secret scan over an incremental blob ledger, with built-in functions only.

Every historical version of a file is addressed by the SHA-256 of its content. The ledger holds one row per
(blob, rules scanned in that run) with the spans found. A run scans a blob only for the rule versions that the
ledger has not yet seen for it, appends what it found, and joins the findings back to every path and version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.common import stash, text_of


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``needs``: plain texts of which a hit holds at least one (a cheap test before the pattern).

    ``value_group`` and ``min_value``: a match counts only if that group has so many characters.
    """

    kind: str
    version: int
    pattern: str
    needs: tuple[str, ...] = ()
    value_group: int = 0
    min_value: int = 1

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


#: In the order of the contract. For access and hex the least length stands in the pattern: a run of the class
#: that is too short holds no other match, so dropping it afterwards gives the same spans. For assign it does
#: not (a short match may cover the start of another), so its length is tested afterwards.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", (":", "="), 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)

#: The kinds that ``base_sha256`` covers; rules of other kinds add spans and leave it as it is.
BASE_KINDS = ("assign", "access", "hex")

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rules", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN))])


def _lengths(strings: Column) -> Column:
    return F.transform(strings, F.length)


def _scan(rule: Rule, content: Column, todo: Column) -> Column:
    """Per rule: lengths of the pieces between matches, of the matches, and of their values; null without a match."""
    pattern = F.lit(rule.pattern)
    maybe = F.array_contains(todo, rule.tag)
    if rule.needs:
        has = F.lit(False)
        for text in rule.needs:
            has = has | content.contains(text)
        maybe = maybe & has
    return F.when(
        maybe & content.rlike(rule.pattern),
        F.struct(
            F.lit(rule.kind).alias("kind"),
            F.arrays_zip(
                _lengths(F.split(content, rule.pattern, -1)).alias("gap"),
                _lengths(F.regexp_extract_all(content, pattern, 0)).alias("len"),
                _lengths(F.regexp_extract_all(content, pattern, rule.value_group)).alias("value"),
            ).alias("cuts"),
        ),
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blobs(blob, content, todo) -> rows of LEDGER, one per blob, blobs without findings included.

    Needs its input hash-partitioned by blob to stay within one shuffle; positions are running sums over the
    pieces of one blob and rule.
    """
    hits = F.filter(F.array(*[_scan(r, F.col("content"), F.col("todo")) for r in rules]), lambda x: x.isNotNull())
    each = blobs.select("blob", "todo", hits.alias("hits")).select("blob", "todo", F.explode_outer("hits").alias("hit"))
    each = each.select("blob", "todo", F.col("hit.kind").alias("kind"), F.posexplode_outer("hit.cuts").alias("pos", "cut"))
    so_far = Window.partitionBy("blob", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.select(
        "blob", "todo", "kind", F.col("cut.len").alias("len"), F.col("cut.value").alias("value"),
        (F.sum("cut.gap").over(so_far) + F.sum(F.coalesce("cut.len", F.lit(0))).over(so_far)).cast("long").alias("end"),
    )
    long_enough = F.lit(False)
    for r in rules:
        long_enough = long_enough | ((F.col("kind") == r.kind) & (F.col("value") >= r.min_value))
    span = F.when(F.col("len").isNotNull() & long_enough, F.struct((F.col("end") - F.col("len")).alias("start"), F.col("end"), F.col("kind")))
    return each.groupBy("blob").agg(F.first("todo").alias("rules"), F.collect_list(span).alias("spans"))


def read_ledger(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob for the given rule versions: blob, rules seen, spans (each once, by start, then rule order)."""
    tags = [r.tag for r in rules]
    live = F.filter("rules", lambda t: t.isin(tags))
    kinds = F.transform(live, lambda t: F.split_part(t, F.lit("@"), F.lit(1)))
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    rows = spark.read.schema(LEDGER).parquet(ledger).select("blob", live.alias("rules"), F.filter("spans", lambda s: F.array_contains(kinds, s["kind"])).alias("spans"))
    rows = rows.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("rules"), F.flatten(F.collect_list("spans")).alias("spans"))
    ordered = F.array_sort(F.array_distinct(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))))
    return rows.select("blob", F.array_distinct("rules").alias("rules"), ordered.alias("spans"))


def scan_versions(versions: DataFrame, ledger: str, *, content: str = "content", rules: tuple[Rule, ...] = RULES, first_run: bool = False) -> DataFrame:
    """Scan what the ledger has not seen, append it, and return every row of ``versions`` with its findings.

    versions: any columns (path, version, ...) and the content column. ledger: a folder; ``first_run`` says that it
    holds nothing yet. Returns the other columns of ``versions`` plus ``blob`` and ``spans``
    (array of start, rank, end, kind; code points, end exclusive). An input column named blob or spans is replaced.

    Null content counts as empty and has no findings; repeated rows are each returned; an empty table gives no
    rows; texts of any length are scanned whole. Equal contents are scanned once, whatever their number: the
    first copy is kept by a partial aggregate before the shuffle. A lost run leaves at most ledger rows that a
    later run repeats; reading removes repeats. The findings are written before they are joined back, so that both
    sides of that join are plain exchanges and Spark splits the rows of a frequent content over several tasks.
    """
    spark = versions.sparkSession
    tags = F.array(*[F.lit(r.tag) for r in rules])
    text = text_of(content)
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("content")).groupBy("blob").agg(F.first("content").alias("content"))
    if first_run:
        todo = blobs.withColumn("todo", tags)
    else:
        seen = read_ledger(spark, ledger, rules).select("blob", F.col("rules").alias("seen"))
        todo = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(tags, F.coalesce("seen", F.array().cast("array<string>"))))
        todo = todo.filter(F.size("todo") > 0).drop("seen")
    scan_blobs(todo, rules).write.mode("append").parquet(ledger)
    found = stash(read_ledger(spark, ledger, rules).select("blob", "spans").filter(F.size("spans") > 0), "findings")
    kept = [c for c in versions.columns if c not in (content, "blob", "spans")]
    return versions.select(*[F.col(f"`{c}`") for c in kept], F.sha2(text, 256).alias("blob")).join(found, "blob", "left")


def digest(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """Columns of the contract from ``spans``: a count per kind, the digest of the base spans and all spans as text."""
    spans = F.coalesce(F.col("spans"), F.array().cast(findings.schema["spans"].dataType))
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    listed = F.array_join(F.transform(spans, said), ",")
    base = F.array_join(F.transform(F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS)), said), ",")
    of_kind = lambda kind: lambda s: s["kind"] == kind  # noqa: E731  (filter() reads a second parameter as the index)
    counts = [F.size(F.filter(spans, of_kind(r.kind))).cast("long").alias(f"n_{r.kind}") for r in rules]
    return [*counts, F.sha2(base, 256).alias("base_sha256"), listed.alias("spans")]
