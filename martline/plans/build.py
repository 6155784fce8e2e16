"""The layered build: staging, gate, marts, history, gate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline import schemas
from martline.operators import clean, quality
from martline.functions.keys import packed, packed_key, put_back_values
from martline.operators.details import HASHED, MEASURES, order_details, short_details, stage_details
from martline.operators.history import scd2_overlaps
from martline.operators.joins import hot_keys_for, input_bytes, missing_days
from martline.operators.metrics import Thresholds, customer_metrics, product_metrics
from martline.plans import dates, marts
from martline.sources.files import (
    CODEC,
    MONTH,
    commit_version,
    has_months,
    in_parts,
    read_short,
    read_table,
    read_version,
    rule_counts,
    upsert_increment,
    write_version_in_parts,
)
from martline.sources.snapshots import snapshot
from martline.sources.staging import shuffles_freed, temporary_stages


#: The wide table is written in parts of about so many bytes of the fact, but not more than so many, since each
#: part shuffles the dimensions again and has few tasks. Lines as they come in and the fact are written in up
#: to so many shares of the orders, each of which reads all lines.
PART_BYTES, MOST_PARTS, MOST_SHARES = 64 * 2**20, 12, 2


def _parts_of(rows: DataFrame, most: int = MOST_PARTS) -> int:
    return max(1, min(most, -(-input_bytes(rows) // PART_BYTES)))


def _shares(lines: DataFrame, n: int) -> list[DataFrame]:
    """``lines`` in ``n`` frames of whole orders, for steps that treat each order on its own."""
    share = F.pmod(F.xxhash64(F.lit(23), "order_id"), F.lit(n))
    return [lines.where(share == i) for i in range(n)] if n > 1 else [lines]


#: Queries on details that are not kept make them in shares of about so many bytes of the lines.
SHARE_BYTES, MOST_QUERY_SHARES = 2**30, 6


def query_shares(raw: DataFrame, lines: DataFrame) -> list[DataFrame]:
    """``lines``, made of ``raw``, in one frame where all shuffles of a query may be on disk at once, else in several of whole orders."""
    return _shares(lines, max(1, min(MOST_QUERY_SHARES, -(-input_bytes(raw) // SHARE_BYTES))))


@dataclass(frozen=True)
class Raw:
    """Bronze frames; ``stream`` is optional."""

    customers: DataFrame
    products: DataFrame
    sales: DataFrame
    stream: DataFrame | None = None


@dataclass(frozen=True)
class Settings:
    root: str
    as_of: date
    run_ts: datetime
    thresholds: Thresholds = Thresholds()
    first_day: date = dates.SPINE_START
    last_day: date = dates.SPINE_END
    cohorts: Sequence[str] = field(default_factory=lambda: schemas.COHORTS)
    income_brackets: Sequence[str] = field(default_factory=lambda: schemas.INCOME_BRACKETS)
    channels: Sequence[str] = field(default_factory=lambda: schemas.CHANNELS)
    quantities: Sequence[int] = field(default_factory=lambda: schemas.FACT_QUANTITIES)
    full_refresh: bool = False

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def _unique(*columns: tuple[str, DataFrame, str]) -> list[quality.Check]:
    # Only the number of repeated keys is asked for: texts are compared as bytes, hashes as half as many.
    def keys(df: DataFrame, c: str) -> DataFrame:
        if c not in df.columns:
            return df.select(packed_key(df, c, HASHED[c]).alias(c))
        return df.select(packed(F.col(c)).alias(c)) if c.endswith("_sk") and dict(df.dtypes)[c] == "string" else df

    return [quality.violations(quality.ERROR, f"{table}.{c}.unique", quality.check_unique(keys(df, c), c)) for table, df, c in columns]


def _related(table: str, df: DataFrame, *links: tuple[str, DataFrame, str]) -> list[quality.Check]:
    return [
        quality.foreign_key(df, c, *parent, broken=f"{table}.{c}.relationship") for c, *parent in links
    ]


def staging_rules(s: Settings) -> dict[str, quality.Watch]:
    """Row rules of the staging tables."""
    watches = [
        quality.Watch("stg_customers", not_null=["customer_sk", "customer_id", "email", "cohort"], accepted={"cohort": s.cohorts}),
        quality.Watch("stg_products", not_null=["product_sk", "product_id", "product_name", "list_price"]),
        quality.Watch("stg_sales", not_null=["order_line_sk", "order_id", "quantity", "unit_price"]),
    ]
    return {w.table: w for w in watches}


def mart_rules(s: Settings) -> dict[str, quality.Watch]:
    """Row rules of the marts."""
    in_range = F.col("profit_margin_pct").between(-100, 100)
    watches = [
        quality.Watch("dim_customer", not_null=["customer_sk", "customer_id", "email", "cohort"],
                      accepted={"income_bracket": s.income_brackets}),
        quality.Watch("dim_product", not_null=["product_sk", "product_id", "product_name", "list_price"]),
        quality.Watch("dim_date", not_null=["date_sk", "date_actual", "year"]),
        quality.Watch("fact_sales",
                      not_null=["order_line_sk", "customer_sk", "product_sk", "order_date_sk", "order_id",
                                "quantity", "unit_price", "net_revenue", "channel", "profit_margin_pct"],
                      accepted={"quantity": s.quantities, "channel": s.channels, "is_bad_data_record": [0, 1]},
                      warnings={"margin_range": ~in_range}),
    ]
    return {w.table: w for w in watches}


def _row_rules(
    watches: Mapping[str, quality.Watch], frames: Mapping[str, DataFrame], counted: Mapping[str, Mapping[str, int]]
) -> list[quality.Check]:
    """Row rules as the writes have counted them, by a scan where no write has."""
    return [
        w.check(frames[t].sparkSession, counted[t]) if t in counted else w.scan(frames[t]) for t, w in watches.items()
    ]


def staging_checks(
    customers: DataFrame, products: DataFrame, sales: DataFrame, s: Settings,
    counted: Mapping[str, Mapping[str, int]] | None = None,
) -> list[quality.Check]:
    frames = {"stg_customers": customers, "stg_products": products, "stg_sales": sales}
    return [
        *_row_rules(staging_rules(s), frames, counted or {}),
        *_unique(("stg_customers", customers, "customer_sk"), ("stg_customers", customers, "customer_id"),
                 ("stg_products", products, "product_sk"), ("stg_products", products, "product_id"),
                 ("stg_sales", sales, "order_line_sk")),
        *_related("stg_sales", sales, ("customer_id", customers, "customer_id"),
                  ("product_id", products, "product_id")),
    ]


def mart_checks(
    customers: DataFrame, products: DataFrame, days: DataFrame, fact: DataFrame, s: Settings,
    counted: Mapping[str, Mapping[str, int]] | None = None,
) -> list[quality.Check]:
    """``fact`` may come with its keys set aside, as ``read_short`` reads it, if its row rules are ``counted``."""
    q = quality
    frames = {"dim_customer": customers, "dim_product": products, "dim_date": days, "fact_sales": fact}
    return [
        *_row_rules(mart_rules(s), frames, counted or {}),
        *_unique(("dim_customer", customers, "customer_sk"), ("dim_customer", customers, "customer_id"),
                 ("dim_product", products, "product_sk"), ("dim_product", products, "product_id"),
                 ("dim_date", days, "date_sk"), ("dim_date", days, "date_actual"),
                 ("fact_sales", fact, "order_line_sk")),
        *_related("fact_sales", fact, ("order_date_sk", days, "date_sk")),
        q.foreign_key(fact, "customer_sk", customers, "customer_sk", broken="fact_sales.customer_sk.relationship",
                      orphan_keys="fact_sales.dimensions_complete", orphan_rows="fact_sales.customer_orphans",
                      made_of=HASHED["customer_sk"]),
        q.foreign_key(fact, "product_sk", products, "product_sk", broken="fact_sales.product_sk.relationship",
                      orphan_keys="fact_sales.dimensions_complete", made_of=HASHED["product_sk"]),
        q.violations(q.WARN, "fact_sales.daily_gaps", missing_days(fact, days)),
    ]


def anomaly_checks(sales: DataFrame, as_of: date) -> list[quality.Check]:
    """Duplicate lines and rule breaks of ``sales``: the clean table passes by
    construction, ``clean.union_sales`` shows what the source holds."""
    q = quality
    return [
        q.violations(q.ERROR, "sales.duplicate_lines", q.duplicates(sales, clean.SALES_KEYS)),
        q.rules("sales", sales, errors={
            "future_dates": F.col("order_date") > F.lit(as_of),
            "negative_quantity": F.col("quantity") < 0,
            "zero_price": F.col("unit_price") <= 0}),
    ]


def source_checks(raw: Raw, as_of: date) -> list[quality.Check]:
    stale = quality.freshness(
        {
            "raw_customers": (raw.customers, "signup_date"),
            "raw_products": (raw.products, "launch_date"),
            "raw_sales": (raw.sales, "order_date"),
        },
        as_of,
    )
    return [quality.violations(quality.WARN, "sources.freshness", stale)]


def history_checks(history: DataFrame) -> list[quality.Check]:
    overlaps = {False: "starts_in_order", True: "no_overlap"}
    return [
        quality.violations(
            quality.WARN, f"snap_customers.{name}", scd2_overlaps(history, "customer_id", strict=strict)
        )
        for strict, name in overlaps.items()
    ]


def _hashed(rows: DataFrame) -> dict[str, list[str]]:
    """The surrogate keys of a table that it need not store."""
    return {key: columns for key, columns in HASHED.items() if {key, *columns} <= set(rows.columns)}


def together(*steps: Callable) -> list:
    """Run independent steps side by side, so that small ones fill idle executors."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, step) for step in steps]]


def build(spark: SparkSession, raw: Raw, s: Settings) -> dict[str, DataFrame]:
    """Run every layer and return its tables, each stored under ``s.root``.

    The staging gate stops the build before any mart is touched; the mart gate runs beside the
    wide table and the snapshots, but for the check that reads these. Row rules are counted by the
    writes, and readers see staging tables, dimensions and the wide table only once
    their gate has passed; the fact is committed when its own rules hold. A large fact written anew holds all
    order details, and the dimensions are measured on it; otherwise the details are staged. Each step's shuffle
    files go when it ends, the checks of a gate run one after the other, clean lines and fact are written some
    orders at a time, and the wide table, whose rows are the longest to move, some months at a time.
    Tables are stored without keys that are hashes, and fact and wide table without the money measures:
    readers of the returned frames, of ``load_table`` and of ``read_table`` get them made again.
    """
    with temporary_stages(spark), shuffles_freed(spark):
        return _build(spark, raw, s)


def _build(spark: SparkSession, raw: Raw, s: Settings) -> dict[str, DataFrame]:
    report: dict[str, int] = {}
    tables: dict[str, DataFrame] = {}

    watches = staging_rules(s) | mart_rules(s)
    written: list[tuple[DataFrame, str, str]] = []

    def keep(name: str, make: Callable[[], DataFrame], parts: int = 1):
        """Write a table and count its row rules; ``commit`` makes it what readers see."""

        def step() -> DataFrame:
            made = _shares(make(), parts)
            rows, version = write_version_in_parts(made, s.path(name), None, watches.get(name), hashed=_hashed(made[0]))
            written.append((rows, s.path(name), version))
            tables[name] = rows
            return rows

        return step

    def short(name: str) -> DataFrame:
        """A kept table without the keys that it does not store."""
        (version,) = [v for _, path, v in written if path == s.path(name)]
        return read_version(spark, s.path(name), version, tables[name].schema, hashed=_hashed(tables[name]))

    def seen(*names: str) -> dict[str, dict[str, int]]:
        return {name: watches[name].seen() for name in names}

    def commit() -> None:
        while written:
            commit_version(*written.pop())

    customers, products, sales = together(
        keep("stg_customers", lambda: clean.stg_customers(raw.customers)),
        keep("stg_products", lambda: clean.stg_products(raw.products)),
        keep("stg_sales", lambda: clean.stg_sales(raw.sales, raw.stream, as_of=s.as_of), _parts_of(raw.sales, MOST_SHARES)),
    )
    # Rejects not beside the lines, whose shuffles are as large.
    lines = short("stg_sales")
    _, found = together(
        keep("stg_sales_rejected", lambda: clean.rejected_sales(raw.sales, as_of=s.as_of)),
        lambda: quality.enforce(staging_checks(customers, products, lines, s, seen(*staging_rules(s)))),
    )
    report |= found
    commit()

    days = keep("dim_date", lambda: dates.dim_date(dates.date_spine(spark, s.first_day, s.last_day)))()
    hot = hot_keys_for(sales, {"customer_id": customers, "product_id": products})
    with temporary_stages(spark):  # the details and the ranks are on disk until the fact is written
        n = _parts_of(sales, MOST_SHARES)
        joined = {"products": products, "customers": customers, "hot_products": hot["product_id"], "hot_customers": hot["customer_id"]}
        # A fact that is written anew holds all details; an increment does not, so the metrics need them apart. Lines of
        # one share are few enough to be written twice.
        anew = n > 1 and (s.full_refresh or not has_months(spark, s.path("fact_sales")))
        details = [short_details(share, **joined) for share in _shares(lines, n)] if anew else [
            stage_details([order_details(share, **joined) for share in _shares(sales, n)], codec=CODEC)]
        # One load time, however many parts are written.
        loaded = F.lit(datetime.now(timezone.utc))
        rows = [marts.fact_sales(part, days).withColumn("loaded_at", loaded) for part in details]
        upsert_increment(rows, s.path("fact_sales"), full_refresh=s.full_refresh, watch=watches["fact_sales"], hashed=HASHED, derived=MEASURES)
        fact = read_short(spark, s.path("fact_sales"), HASHED, MEASURES)
        measured = put_back_values(fact, MEASURES) if anew else details[0]
        customer_dim, product_dim = together(
            keep("dim_customer", lambda: marts.dim_customer(
                customers, customer_metrics(measured, as_of=s.as_of, thresholds=s.thresholds, counts=["total_orders"]),
                as_of=s.as_of)),
            keep("dim_product", lambda: marts.dim_product(
                products, product_metrics(measured, counts=[]), as_of=s.as_of)),
        )
    tables["fact_sales"] = read_table(spark, s.path("fact_sales"))
    counted = {"fact_sales": rule_counts(spark, s.path("fact_sales"))} | seen("dim_customer", "dim_product", "dim_date")

    def wide() -> DataFrame:
        month = {MONTH: F.date_format("order_date", "yyyy-MM")}
        parts = in_parts(fact, _parts_of(fact))
        made = (marts.obt_sales(part, customer_dim, product_dim, days, **marts.hot_sks(hot), gather=month, short=True) for part in parts)
        line_key = {"order_line_sk": HASHED["order_line_sk"]}  # the only one that the table holds
        rows, version = write_version_in_parts(made, s.path("obt_sales"), MONTH, hashed=line_key, derived=MEASURES,
                                               order=["customer_id", "order_id", "line_item_id"])
        rows = rows.select(*marts.FACT_COLUMNS, *[c for c in rows.columns if c not in marts.FACT_COLUMNS])
        written.append((rows, s.path("obt_sales"), version))
        tables["obt_sales"] = rows
        return rows

    def versions(name: str, df: DataFrame, key: str, columns: list[str], tracked: list[str]):
        def step() -> DataFrame:
            path = s.path(name)
            tables[name] = snapshot(df.select(*columns), key, tracked, path, s.run_ts)
            return tables[name]

        return step

    def gate() -> dict[str, int]:
        checks = mart_checks(customer_dim, product_dim, days, fact, s, counted) + source_checks(raw, s.as_of)
        return quality.enforce(checks) | quality.enforce(anomaly_checks(lines, s.as_of))

    _, found, history, _ = together(
        wide,
        gate,
        versions("snap_customers", customers, "customer_id",
                 schemas.CUSTOMER_HISTORY, schemas.CUSTOMER_TRACKED),
        versions("snap_products", products, "product_id",
                 schemas.PRODUCT_HISTORY, schemas.PRODUCT_TRACKED),
    )

    report |= found | quality.enforce(history_checks(history))
    commit()
    tables["gate_report"] = spark.createDataFrame(
        sorted(report.items()), "check string, violations bigint"
    )
    return tables
