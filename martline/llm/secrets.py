"""Secret scans over a ledger of content-addressed texts.

Every version of a text is addressed by its SHA-256. The ledger holds one row
per scanned blob and run: which rules, in which version, have seen it, and what
they found. A run scans only pairs of blob and rule version that the ledger does
not hold, each blob once however many paths carry it, and joins all findings
back to every path; blobs that very many paths carry are split for that join.

Findings are spans in code points, end exclusive. A rule's pattern runs over the
text from left to right without overlaps; a match shorter than the rule asks for
is dropped after it has been matched.

Defined results: a null text is the empty blob and has no findings; repeated
paths get their findings each. Columns of the input pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martline.llm.common import column, whole
from martline.operators.joins import hot_keys, left_join
from martline.sources.staging import stage


@dataclass(frozen=True)
class Rule:
    """A match counts if its ``group`` (0: all of it) has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds. Where a match is a whole run of one class, its
#: least length is part of the pattern: a run that is too short holds no other match.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE = (
    Rule("assign", 1, ASSIGN, 12, 2),
    Rule("access", 1, "AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, "[0-9a-f]{16,}"),
)
MORE = (
    Rule("pem", 1, "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("forge", 1, "gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + MORE

_FINDINGS = "array<struct<start:int,place:int,stop:int,kind:string,rule:string>>"
_BLOB = -1  # the place of the row that stands for a blob as a whole
LEDGER = f"blob binary, rules array<string>, findings {_FINDINGS}"


def address(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes; a null text is the empty one."""
    return F.unhex(F.sha2(whole(text).cast("binary"), 256))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder)


_PIECES = "array<struct<place:int,skip:int,long:int,counts:boolean>>"


def pieces(text: Column, rule: Rule, place: int) -> Column:
    """All matches of one rule, in order: characters skipped before it, its own, and whether it is long enough.

    Splitting with limit -1 drops nothing, so piece, match, piece, match follow
    each other in the text and their lengths add up to the places.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.slice(F.split(text, rule.pattern, -1), 1, F.size(found))
    parts = F.zip_with(
        F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("skip"), F.length(m).alias("long"))),
        measured,
        lambda p, g: F.struct(
            F.lit(place).alias("place"), p["skip"].alias("skip"), p["long"].alias("long"), (F.length(g) >= rule.least).alias("counts")
        ),
    )
    return F.when(text.rlike(rule.pattern), parts).otherwise(F.array().cast(_PIECES))


def scan(docs: DataFrame, ledger: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Ledger rows for all pairs of blob and rule version that ``ledger`` does not hold.

    Copies of a blob are cut down to one per task before they are shuffled.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    texts = docs.select(address(column(text)).alias("blob"), whole(column(text)).alias("text"))
    one = Window.partitionBy("blob").orderBy("blob")
    blobs = texts.withColumn("copy", F.row_number().over(one)).where("copy = 1").drop("copy")
    todo = blobs.join(seen, "blob", "left").withColumn(
        "rules", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
    )
    # Rows of a blob lie in one task already; lengths are added up along them, so the work is linear in the matches.
    none, blob = F.array().cast(_PIECES), F.struct(F.lit(_BLOB).alias("place"), F.lit(0).alias("skip"), F.lit(0).alias("long"), F.lit(False).alias("counts"))
    found = F.flatten(F.array(F.array(blob), *[
        F.when(F.array_contains("rules", r.name), pieces(F.col("text"), r, i)).otherwise(none) for i, r in enumerate(rules)
    ]))
    listed = todo.where(F.size("rules") > 0).select("blob", "rules", F.posexplode(found).alias("nth", "p")).select("blob", "rules", "nth", "p.*")
    so_far = Window.partitionBy("blob", "place").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = listed.withColumn("stop", F.sum(F.col("skip") + F.col("long")).over(so_far).cast("int"))
    kinds, rule_names = F.array(*[F.lit(r.kind) for r in rules]), names
    finding = F.struct(
        (F.col("stop") - F.col("long")).alias("start"), "place", "stop", kinds[F.col("place")].alias("kind"), rule_names[F.col("place")].alias("rule")
    )
    return at.groupBy("blob").agg(F.first("rules").alias("rules"), F.sort_array(F.collect_list(F.when(F.col("counts"), finding))).alias("findings"))


def _once(findings: Column) -> Column:
    """The different ones of sorted findings, told by their neighbour."""
    return F.transform(F.array(findings), lambda all_: F.filter(all_, lambda f, i: (i == 0) | (f != all_[i - 1])))[0]


def record(docs: DataFrame, folder: str, text: str = "text", rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger in ``folder`` does not hold and append it."""
    scan(docs, read_ledger(docs.sparkSession, folder), text, rules).write.mode("append").parquet(folder)


def find_secrets(
    docs: DataFrame, folder: str, text: str = "text", rules: Sequence[Rule] = RULES, into: str = "secrets"
) -> DataFrame:
    """Scan what is new, add it to the ledger in ``folder``, give every row of ``docs`` its findings.

    Each ledger row stands for itself: after a broken run the next one scans
    what is missing.
    """
    spark = docs.sparkSession
    record(docs, folder, text, rules)
    wanted = F.array(*[F.lit(r.name) for r in rules])
    kept = F.filter("findings", lambda f: F.array_contains(wanted, f["rule"]))
    # A pair that two runs scanned at the same time is there twice; equal findings count once.
    known = read_ledger(spark, folder).where(F.size("findings") > 0).groupBy("blob").agg(
        _once(F.sort_array(F.flatten(F.collect_list(kept)))).alias("found"))
    own = [c for c in docs.columns if c.lower() != into.lower()]
    rows = docs.select(
        address(column(text)).alias("blob"), F.struct(*[column(c) for c in own]).alias("row"),
        F.xxhash64(*[column(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]).alias("spread"),
    )
    hot = stage(hot_keys(rows, "blob"), "secret-hot-blobs")
    met = left_join(rows, known, "blob", "spread", hot=hot)
    return met.select("row.*", F.coalesce("found", F.array().cast(_FINDINGS)).alias(into))


def listed(findings: Column) -> Column:
    """kind:start:stop, joined by commas in the order of the findings."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])), ",")
