"""Order lines with product cost and money measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions.keys import Derived, as_derived, put_back, put_back_values, set_aside, set_aside_values
from martline.operators.joins import left_join
from martline.sources.staging import stage_all

MONEY = "decimal(18,2)"

#: Surrogate keys and the columns that they usually are the hash of.
HASHED = {"order_line_sk": ["order_id", "line_item_id"], "customer_sk": ["customer_id"], "product_sk": ["product_id"]}


def order_details(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame | None,
    *,
    hot_products: DataFrame | None = None,
    hot_customers: DataFrame | None = None,
) -> DataFrame:
    """Clean lines joined with product cost and customer key.

    ``hot_products`` and ``hot_customers`` (see ``joins.hot_keys``) may be counted
    on the raw lines, which are cheaper to read than the cleaned ones. Surrogate keys
    stay out of the shuffles and are hashed again after them. Without ``customers``, for
    steps that read no customer key, the lines are not moved to meet them.
    """
    lines = _joined(sales, products, customers, hot_products, hot_customers)
    for key, columns in HASHED.items():
        lines = put_back(lines, key, columns)
    own = [c for c in sales.columns if c not in ("customer_id", "product_id", "loaded_at")]
    found = [] if customers is None else ["customer_sk"]
    return with_measures(
        lines.select("customer_id", "product_id", *own, "product_sk", "list_price", "standard_cost", *found)
    )


def short_details(
    sales: DataFrame, products: DataFrame, customers: DataFrame, *, hot_products: DataFrame | None = None, hot_customers: DataFrame | None = None
) -> DataFrame:
    """``order_details`` with keys and measures set aside, for a writer that stores neither: they are not made first to be taken off."""
    return as_derived(_joined(sales, products, customers, hot_products, hot_customers), MEASURES)


def _joined(
    sales: DataFrame, products: DataFrame, customers: DataFrame | None, hot_products: DataFrame | None, hot_customers: DataFrame | None
) -> DataFrame:
    products = products.select("product_id", "product_sk", "list_price", "standard_cost")
    lines, products = (
        set_aside(df, key, HASHED[key]) for df, key in ((sales.drop("loaded_at"), "order_line_sk"), (products, "product_sk"))
    )
    spread_by = HASHED["order_line_sk"]
    lines = left_join(lines, products, "product_id", spread_by, hot=hot_products)
    if customers is not None:
        customers = set_aside(customers.select("customer_id", "customer_sk"), "customer_sk", HASHED["customer_sk"])
        lines = left_join(lines, customers, "customer_id", spread_by, hot=hot_customers)
    return lines


def _money(text: str) -> str:
    return f"CAST({text} AS {MONEY})"


def _measures() -> dict[str, str]:
    gross, net, total = (_money(f"quantity * {c}") for c in ("unit_price", "(unit_price - discount_amount)", "standard_cost"))
    margin = f"CAST({net} - {total} AS double) / CAST({gross} AS double) * 100"
    return {
        "gross_revenue": gross,
        "net_revenue": net,
        "total_cost": total,
        "gross_profit": _money(f"{gross} - {total}"),
        "net_profit": _money(f"{net} - {total}"),
        "profit_margin_pct": f"CASE WHEN {gross} > 0 THEN {margin} END",
    }


#: The money measures and the columns that they are made of.
MEASURES = Derived(_measures(), ["quantity", "unit_price", "discount_amount", "standard_cost"])


def with_measures(lines: DataFrame) -> DataFrame:
    """Money measures per line. The discount is per unit, on top of ``unit_price``."""
    return lines.withColumns(MEASURES.values())


def stage_details(
    details: DataFrame | Sequence[DataFrame], columns: Sequence[str] | None = None, codec: str | None = None
) -> DataFrame:
    """Write ``details``, or ``columns`` of them, once; keys and measures are made again when they are read.

    Details given as several frames of one form are written one after the other to one table.
    """
    frames = [details] if isinstance(details, DataFrame) else list(details)
    short = stage_all((_short_details(f, columns or f.columns) for f in frames), "details", codec)
    for key, parts in HASHED.items():
        short = put_back(short, key, parts)
    return put_back_values(short, MEASURES).select(*(columns or frames[0].columns))


def _short_details(details: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """What ``wanted`` columns are made of."""
    short = details
    for key, parts in HASHED.items():
        short = set_aside(short, key, parts) if {key, *parts} <= set(details.columns) else short
    short = set_aside_values(short, MEASURES)
    kept = {c: [c] for c in details.columns if c in short.columns}
    kept |= {c: [*HASHED[c], f"_own_{c}", f"_odd_{c}"] for c in HASHED if c in details.columns and c not in short.columns}
    made = {c: [*MEASURES.inputs, "_own_values", "_odd_values"] for c in details.columns if c not in kept}
    needed = {part for c in wanted for part in (kept | made)[c]}
    return short.select(*[c for c in short.columns if c in needed])
