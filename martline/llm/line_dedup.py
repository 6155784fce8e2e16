"""Drop the lines that a site repeats on too many of its pages.

A line's frequency is relative to its site: pages of the host that contain it,
divided by all pages of the host. Lines above ``max_ratio`` that at least
``min_pages`` pages hold are boilerplate and go; everything else stays as it is.

Defined results: lines are compared without blanks at their ends, blank lines
always stay. Each row counts as one page, repeated rows too; a null host is a
host of its own. A null text stays null. Columns of the input pass through.

Only hashes move: 128 bits per line and page for counting, then the few hits per
page. A line that a third of all pages share leaves each task as one count. A
page's text is moved once, to meet its hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import column, free_name, two_hashes

MAX_RATIO, MIN_PAGES = 0.05, 5
_BLANKS = " \t\r"


def _line_hash(line: Column) -> Column:
    a, b = two_hashes(F.btrim(line, F.lit(_BLANKS)))
    return F.struct(a.alias("a"), b.alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _distinct_hashes(text: Column) -> Column:
    """Of the lines with text; strings are made distinct first, by hashing."""
    bare = F.array_distinct(F.transform(_lines(text), lambda x: F.btrim(x, F.lit(_BLANKS))))
    return F.transform(F.filter(bare, lambda x: x != ""), _line_hash)


def boilerplate(
    pages: DataFrame, host: str = "host", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``host``, ``line`` (hash), ``pages`` and ``ratio`` of the lines to drop."""
    totals = pages.groupBy(column(host).alias("host")).agg(F.count("*").alias("total"))
    each = pages.select(column(host).alias("host"), F.explode(_distinct_hashes(column(text))).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    ratio = F.col("pages") / F.col("total")
    return (
        counts.alias("c")
        .join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
        .select("c.host", "line", "pages", ratio.alias("ratio"))
        .where(F.col("ratio") > max_ratio)
    )


def drop_lines(
    pages: DataFrame, key: str = "doc_id", host: str = "host", text: str = "text",
    max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, into: str | None = None,
) -> DataFrame:
    """``pages`` with the boilerplate lines gone from ``text``.

    ``into`` names an additional struct column (n_lines, n_dropped). Rows with
    the same key and host share their hits: whether a line goes depends on host
    and line alone.
    """
    found = boilerplate(pages, host, text, max_ratio, min_pages)
    each = pages.select(
        column(key).alias("key"), column(host).alias("host"), F.explode(_distinct_hashes(column(text))).alias("line")
    )
    hits = (
        each.alias("e")
        .join(found.alias("f"), F.col("e.host").eqNullSafe(F.col("f.host")) & (F.col("e.line") == F.col("f.line")),
              "left_semi")
        .groupBy(F.col("key").alias("hit_key"), F.col("host").alias("hit_host"))
        .agg(F.collect_set("line").alias("hit_lines"))
    )
    names = {c: free_name(pages, c) for c in hits.columns}
    hits = hits.withColumnsRenamed(names)
    k, h, lines = (F.col(names[c]) for c in ("hit_key", "hit_host", "hit_lines"))
    joined = pages.join(hits, column(key).eqNullSafe(k) & column(host).eqNullSafe(h), "left")
    kept = free_name(pages, "kept_lines", hits)
    split = joined.withColumn(kept, F.filter(_lines(column(text)), lambda x: ~F.array_contains(lines, _line_hash(x))))
    cleaned = F.when(lines.isNull(), column(text)).otherwise(F.array_join(column(kept), "\n"))
    columns = [cleaned.alias(c) if c == text else column(c) for c in pages.columns if c != into]
    if into:
        total = F.when(column(text).isNull(), 0).otherwise(F.size(_lines(column(text)))).cast("long")
        gone = F.when(lines.isNull(), 0).otherwise(total - F.size(column(kept))).cast("long")
        columns.append(F.struct(total.alias("n_lines"), gone.alias("n_dropped")).alias(into))
    return split.select(*columns)
