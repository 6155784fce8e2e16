"""Data-quality checks and the gate."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martline.functions.keys import held_key, packed, packed_key
from martline.operators.joins import orphans

ERROR = "error"
WARN = "warn"


class GateError(RuntimeError):
    """A check of error severity found violations."""

    def __init__(self, failed: dict[str, int]):
        self.failed = failed
        super().__init__("; ".join(f"{name}: {n}" for name, n in failed.items()))


def count_where(df: DataFrame, rules: Mapping[str, Column], label: str = "check") -> DataFrame:
    """Rows that meet each rule, all rules in one pass: columns ``label`` and ``violations``."""
    names = list(rules)
    counted = df.agg(
        *[F.coalesce(F.sum(rule.cast("bigint")), F.lit(0)).alias(f"r{i}")
          for i, rule in enumerate(rules.values())]
    )
    pairs = [F.struct(F.lit(n).alias(label), F.col(f"r{i}").alias("violations"))
             for i, n in enumerate(names)]
    return counted.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column in one pass."""
    return count_where(df, {c: F.col(c).isNull() for c in columns}, "column_name")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("occurrence_count"))
    return counts.where("occurrence_count > 1")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values of ``column`` that occur more than once."""
    return duplicates(df.where(F.col(column).isNotNull()), [column])


def check_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted ones, with their rows; nulls pass."""
    counts = df.groupBy(column).agg(F.count("*").alias("occurrence_count"))
    return counts.where(~F.col(column).isin(list(values)))


def check_fk(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null values of ``column`` without a parent, with their rows.

    Rows are counted per value first, so the join sees each value once.
    """
    children = df.where(F.col(column).isNotNull()).groupBy(column)
    counts = children.agg(F.count("*").alias("occurrence_count"))
    parents = parent.select(F.col(parent_column).alias(column))
    return counts.join(parents, column, "left_anti")


def future_dates(sales: DataFrame, as_of: date) -> DataFrame:
    return sales.where(F.col("order_date") > F.lit(as_of)).select("order_id", "order_date")


def negative_quantities(sales: DataFrame) -> DataFrame:
    return sales.where("quantity < 0").select("order_id", "line_item_id", "quantity")


def zero_prices(sales: DataFrame) -> DataFrame:
    return sales.where("unit_price <= 0").select("order_id", "line_item_id", "unit_price")


def margins_out_of_range(fact: DataFrame, low: float = -100, high: float = 100) -> DataFrame:
    margin = F.col("profit_margin_pct")
    return fact.where((margin < low) | (margin > high)).select("order_line_sk", "order_id", margin)


def orphan_report(fact: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Key values of the fact that a dimension lacks, null included, by key column."""
    missing = [
        orphans(fact, dim, key).select(
            F.lit(f"missing_{key}").alias("check_type"), F.col(key).alias("missing_key")
        )
        for key, dim in parents.items()
    ]
    return reduce(DataFrame.unionByName, missing)


def freshness(
    sources: Mapping[str, tuple[DataFrame, str]], as_of: date, max_days: int | None = 30
) -> DataFrame:
    """Newest date per source and its age; only sources older than ``max_days``."""
    newest = [
        df.agg(F.max(F.col(column).try_cast("date")).alias("max_date")).select(
            F.lit(name).alias("source"), "max_date"
        )
        for name, (df, column) in sources.items()
    ]
    today = F.lit(as_of)
    aged = reduce(DataFrame.unionByName, newest).select(
        "source", "max_date", today.alias("today"), F.datediff(today, "max_date").alias("days_old")
    )
    return aged if max_days is None else aged.where(F.col("days_old") > max_days)


def sales_profile(sales: DataFrame) -> DataFrame:
    """Rows, distinct orders and date range in one pass."""
    return sales.agg(
        F.count("*").alias("sales_rows"),
        F.countDistinct("order_id").alias("unique_orders"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


@dataclass(frozen=True)
class Check:
    """Named checks: ``counts`` has columns ``check``, ``severity`` and ``violations``."""

    counts: DataFrame


class Watch:
    """The row rules of one table, counted by a scan or by the write that stores the table.

    ``errors`` and ``warnings`` are true for rows that break the rule.
    """

    def __init__(
        self, table: str, *, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence] | None = None,
        errors: Mapping[str, Column] | None = None, warnings: Mapping[str, Column] | None = None,
    ):
        hard = {f"{c}.not_null": F.col(c).isNull() for c in not_null}
        for column, values in (accepted or {}).items():
            hard[f"{column}.accepted"] = ~F.col(column).isin(list(values))
        self.table = table
        self.conditions = {f"{table}.{name}": rule for name, rule in (hard | {**(errors or {}), **(warnings or {})}).items()}
        self.soft = {f"{table}.{name}" for name in warnings or {}}
        self._seen: list[Observation] = []

    def counters(self) -> list[Column]:
        """One count per rule, named ``r0``, ``r1`` and so on."""
        broken = [F.sum(rule.cast("bigint")) for rule in self.conditions.values()]
        return [F.coalesce(n, F.lit(0)).alias(f"r{i}") for i, n in enumerate(broken)]

    def named(self, row: Mapping[str, int]) -> dict[str, int]:
        """Violations by rule from a row of ``counters``."""
        return {name: row[f"r{i}"] for i, name in enumerate(self.conditions)}

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows``, which are counted when they are next written. Attach last, behind any shuffle, so that no row counts twice.

        Counts of frames that are attached one after the other, as parts of a table, add up.
        """
        self._seen.append(Observation())
        return rows.observe(self._seen[-1], *self.counters())

    def seen(self) -> dict[str, int]:
        """Violations by rule, as the writes have counted them."""
        found = [self.named(seen.get) for seen in self._seen]
        return {name: sum(counts[name] for counts in found) for name in self.conditions}

    def check(self, spark: SparkSession, counts: Mapping[str, int]) -> Check:
        """The check that ``counts`` is the answer of."""
        found = F.array(*[
            F.struct(F.lit(name).alias("check"), F.lit(WARN if name in self.soft else ERROR).alias("severity"),
                     F.lit(n).cast("bigint").alias("violations"))
            for name, n in counts.items()
        ])
        return Check(spark.range(1).select(F.explode(found).alias("_c")).select("_c.*"))

    def scan(self, rows: DataFrame) -> Check:
        """All rules counted in one pass over ``rows``."""
        counts = count_where(rows, self.conditions)
        return Check(counts.withColumn("severity", F.when(F.col("check").isin(list(self.soft)), WARN).otherwise(ERROR)))

    def refuse(self, counts: Mapping[str, int]) -> None:
        """Raise ``GateError`` if rules of error severity are broken."""
        failed = {name: n for name, n in counts.items() if n and name not in self.soft}
        if failed:
            raise GateError(failed)


def rules(table: str, df: DataFrame, **conditions) -> Check:
    """All row rules of one table, counted in one pass; see ``Watch``."""
    return Watch(table, **conditions).scan(df)


def foreign_key(
    df: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    *,
    broken: str,
    orphan_keys: str | None = None,
    orphan_rows: str | None = None,
    made_of: Sequence[str] = (),
) -> Check:
    """Up to three checks of one key from one scan of ``df``, joined once by distinct value.

    ``broken`` (error) counts values without a parent; ``orphan_keys`` (warning)
    counts the missing value too, ``orphan_rows`` (warning) the rows of both. Where ``column`` is set aside
    in ``df``, ``made_of`` names its columns: their values are counted and only these hashed.
    """
    types = dict(df.dtypes)
    both_text = types.get(column, "string") == dict(parent.dtypes)[parent_column] == "string"
    as_key = packed if both_text else lambda c: c  # no key leaves the check, so shorter ones do
    if column in types:
        counts = df.groupBy(as_key(F.col(column)).alias("_key")).agg(F.count("*").alias("_rows"))
    else:
        held = df.groupBy(*held_key(df, column, made_of)).agg(F.count("*").alias("_n"))
        counts = held.groupBy(packed_key(held, column, made_of).alias("_key")).agg(F.sum("_n").alias("_rows"))
    known = parent.select(as_key(F.col(parent_column)).alias("_known")).distinct()
    lost = F.col("_known").isNull()
    met = counts.join(known, F.col("_key") == F.col("_known"), "left").agg(
        F.count_if(lost & F.col("_key").isNotNull()).alias("broken"), F.count_if(lost).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(lost, F.col("_rows"))), F.lit(0)).alias("orphan_rows"),
    )
    asked = [(broken, ERROR, "broken"), (orphan_keys, WARN, "orphan_keys"), (orphan_rows, WARN, "orphan_rows")]
    found = F.array(*[
        F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.col(c).alias("violations"))
        for name, severity, c in asked if name
    ])
    return Check(met.select(F.explode(found).alias("_c")).select("_c.*"))


def violations(severity: str, name: str, rows: DataFrame) -> Check:
    """A check whose result rows are the violations."""
    counted = rows.agg(F.count("*").alias("violations"))
    labels = F.lit(name).alias("check"), F.lit(severity).alias("severity")
    return Check(counted.select(*labels, "violations"))


def run_gate(checks: Sequence[Check]) -> DataFrame:
    """Report of all checks: ``check``, ``severity``, ``violations``; parts of one check add up."""
    reports = reduce(DataFrame.unionByName, [c.counts for c in checks])
    return reports.groupBy("check", "severity").agg(F.sum("violations").alias("violations"))


def enforce(checks: Sequence[Check]) -> dict[str, int]:
    """Run the checks; raise ``GateError`` if one of error severity found something.

    Returns the violations per check, warnings included. One row per check reaches
    the driver. The checks run one after the other, so that only one of them has its
    shuffles on disk where these are deleted with their query (``shuffles_freed``).
    """
    counts = Counter()
    for check in checks:
        for r in run_gate([check]).collect():
            counts[r["check"], r["severity"]] += r["violations"]
    failed = {name: n for (name, severity), n in counts.items() if severity == ERROR and n}
    if failed:
        raise GateError(failed)
    return {name: n for (name, _), n in counts.items()}
