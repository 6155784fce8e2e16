"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line. The build of all marts runs first and is timed as it is;
it also warms the session up. Model queries start from the source tables again
and are timed once; cards read the built tables and are timed after one run to
warm up. All rows of a result are read into a sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

import workload  # noqa: E402
from martline.operators import clean  # noqa: E402
from martline.operators.details import order_details  # noqa: E402
from martline.operators.joins import staged_hot_keys  # noqa: E402
from martline.session import spark_session  # noqa: E402
from martline.sources import retail  # noqa: E402
from martline.sources.staging import stage  # noqa: E402

MODELS = [
    "stg_sales", "stg_sales_with_stream", "rejected_sales", "order_details", "customer_metrics",
    "product_metrics", "global_rank", "seasonality_index", "check_fk", "scd2_merge", "append_new",
]
CARDS = [
    "kpi_revenue", "kpi_orders", "daily_revenue", "revenue_by_category", "top_products",
    "margin_by_product", "recency_frequency", "top_customers", "daily_revenue_of_2000",
]


def salted_details(spark, sf_dir: str) -> None:
    """Details of lines a third of which share a product, without broadcasts: the way for large dimensions."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        sales = clean.stg_sales(retail.raw_sales(spark, sf_dir), as_of=workload.BATCH_DAY)
        hot_third = F.when(F.col("order_id").cast("bigint") % 3 == 0, "1").otherwise(F.col("product_id"))
        sales = stage(sales.withColumn("product_id", hot_third), "bench-sales")
        hot = staged_hot_keys(sales, ["customer_id", "product_id"])
        details = order_details(
            sales, workload._products(spark, sf_dir), workload._customers(spark, sf_dir),
            hot_products=hot["product_id"], hot_customers=hot["customer_id"],
        )
        details.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set(threshold, before)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = spark_session(
        f"local[{cpus}]", cpus,
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def once(run) -> float:
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    def read_all(name: str) -> None:
        workload.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds["build"] = once(lambda: workload.warehouse(spark, sf_dir))
    for name in MODELS:
        seconds[name] = once(lambda: read_all(name))
    seconds["order_details_salted"] = once(lambda: salted_details(spark, sf_dir))
    for name in CARDS:
        read_all(name)
        seconds[name] = once(lambda: read_all(name))
    seconds = {name: round(value, 3) for name, value in seconds.items()}
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
