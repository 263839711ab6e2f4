"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger keeps
which (blob, rule version) pairs have been scanned and what was found; a scan reads only
the pairs that are not in it, whatever number of paths and versions share a blob, and
findings are joined back to all of them. All work is done with SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import scratch_dir

SCANNED = "blob string, rule string"
FINDINGS = "blob string, rule string, kind string, start long, end long"


@dataclass(frozen=True)
class Rule:
    """A pattern; matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The kinds in the order in which they are listed at equal starts.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
)


class BlobLedger:
    """Scanned pairs and findings as two tables in a shared folder.

    A scan appends its findings first and its pairs last. If it fails in between, the
    next one repeats it and appends the same findings, which readers see once.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or scratch_dir(spark, "blob-ledger")
        for name, schema in (("scanned", SCANNED), ("findings", FINDINGS)):
            empty = spark.createDataFrame([], schema)
            empty.write.mode("ignore").parquet(f"{self.folder}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(SCANNED).parquet(f"{self.folder}/scanned")

    def findings(self) -> DataFrame:
        return self.spark.read.schema(FINDINGS).parquet(f"{self.folder}/findings").distinct()

    def scan(self, versions: DataFrame, rules=BASE_RULES) -> None:
        """Scan what the ledger does not have of ``versions`` (a column ``text``)."""
        names = F.array(*[F.lit(rule.name) for rule in rules])
        blobs = addressed(versions).groupBy("blob").agg(F.first("text").alias("text"))
        seen = self.scanned().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        unseen = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
        todo = (
            blobs.join(seen, "blob", "left")
            .select("blob", "text", unseen.alias("todo"))
            .filter(F.size("todo") > 0)
        )
        found_in(todo, rules).write.mode("append").parquet(f"{self.folder}/findings")
        pairs = addressed(versions).select("blob").distinct()
        pairs = pairs.select("blob", F.explode(names).alias("rule"))
        pairs.join(self.scanned(), ["blob", "rule"], "left_anti").write.mode("append").parquet(
            f"{self.folder}/scanned"
        )


def addressed(versions: DataFrame) -> DataFrame:
    """Each row with the address of its content; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [name for name in versions.columns if name not in ("text", "blob")]
    return versions.select(*kept, text.alias("text"), F.sha2(text, 256).alias("blob"))


def found_in(todo: DataFrame, rules) -> DataFrame:
    """Findings of (blob, text, todo): leftmost matches per rule that do not overlap.

    A match's place is the length of what lies before it: of the pieces between matches
    and of the matches themselves, summed over the blob's matches in order.
    """
    matched = todo.select(
        "blob",
        "text",
        *[
            F.when(
                F.array_contains("todo", rule.name),
                F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)),
            ).alias(f"m{i}")
            for i, rule in enumerate(rules)
        ],
    )
    cut = matched.select("blob", F.explode(F.array(*[_cut(i, r) for i, r in enumerate(rules)])))
    rows = cut.filter(F.size("col.matches") > 0).select(
        "blob", "col.i", F.posexplode(F.arrays_zip("col.matches", "col.gaps")).alias("pos", "hit")
    )
    rows = rows.filter("hit.matches IS NOT NULL").select(
        "blob",
        "i",
        "pos",
        F.col("hit.gaps").cast("long").alias("gap"),
        F.length("hit.matches").cast("long").alias("width"),
        _group_length(rules).alias("held"),
    )
    order = Window.partitionBy("blob", "i").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("width")).over(order)
    rows = rows.withColumn("end", end)
    described = _lookup(rules, lambda r: F.struct(
        F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least")
    ))
    return (
        rows.withColumn("r", described)
        .filter(F.col("held") >= F.col("r.least"))
        .select("blob", "r.rule", "r.kind", (F.col("end") - F.col("width")).alias("start"), "end")
    )


def _cut(i: int, rule: Rule) -> Column:
    pieces = F.split("text", rule.pattern, -1)
    return F.struct(
        F.lit(i).alias("i"),
        F.col(f"m{i}").alias("matches"),
        F.when(F.size(f"m{i}") > 0, F.transform(pieces, F.length)).alias("gaps"),
    )


def _group_length(rules) -> Column:
    return _lookup(
        rules,
        lambda r: F.length("hit.matches")
        if r.group == 0
        else F.length(F.regexp_extract("hit.matches", r.pattern, r.group)),
    )


def _lookup(rules, value) -> Column:
    picked = F.when(F.col("i") == 0, value(rules[0]))
    for i, rule in enumerate(rules[1:], 1):
        picked = picked.when(F.col("i") == i, value(rule))
    return picked


def secret_spans(
    versions: DataFrame, ledger: BlobLedger | None = None, rules=BASE_RULES
) -> DataFrame:
    """Per row of ``versions``: its columns without the text, blob and spans.

    ``spans`` is an array of (start, rank, end, kind) in order; rank is the kind's place
    in ``rules``. Positions count code points, ends are exclusive. Without findings, and
    for null and empty texts, the array is empty. A column named ``blob`` or ``spans`` is
    replaced. An empty table gives no rows.
    """
    ledger = ledger or BlobLedger(versions.sparkSession)
    ledger.scan(versions, rules)
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    by_blob = (
        ledger.findings()
        .withColumn("rank", rank[F.col("rule")])
        .filter("rank IS NOT NULL")
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("spans"))
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    rows = addressed(versions).drop("text", "spans")
    return rows.join(by_blob, "blob", "left").withColumn("spans", F.coalesce("spans", none))
