"""Boilerplate lines of a site, by the share of its pages that contain them.

Lines are compared without blanks at their ends, by MD5. The pages of a host are its
distinct texts, so copies of one page are one page and do not make its lines boilerplate.
A line on more than ``max_ratio`` of them, and on at least ``min_pages``, is dropped from
every page of the host. Blank lines are never dropped. With the default of two percent and five
pages, the number of pages decides for hosts of up to 250 pages and the ratio beyond: of a
large host, a line on every fiftieth page is no coincidence.

Counting is an aggregation by (host, line, text), then by (host, line): both combine before
they shuffle, so neither a hot host nor a hot line meets in one task. A page has a bounded
number of lines, so a host drops at most (lines per page / max_ratio) of them: its list is
one small row, and lists are joined to the pages by host. Spark broadcasts all of them while
they are below its threshold and otherwise splits the hot hosts of the join.

* A null text stays null and is not a page. An empty text is a page without lines.
* Rows without a host form one host of their own. A page may lose all lines; its text is
  then empty, and the row stays. Repeated rows are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsmedallion.llm.common import unused
from tsmedallion.session import materialise

MAX_RATIO = 0.02
MIN_PAGES = 5
BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(BLANKS))))


def _host(host: Column) -> Column:
    return F.when(host.isNull(), F.lit("")).otherwise(F.concat(F.lit("#"), host.cast("string")))


def boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """One row per host with boilerplate: host_key, lines (their MD5s)."""
    pages = docs.where(F.col(text_col).isNotNull()).select(
        _host(F.col(host_col)).alias("host_key"), F.unhex(F.md5(text_col)).alias("page"), F.col(text_col).alias("text")
    )
    totals = pages.groupBy("host_key").agg(F.count_distinct("page").alias("pages"))
    keys = F.array_distinct(
        F.transform(
            F.filter(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), _key
        )
    )
    return (
        pages.select("host_key", "page", F.explode(keys).alias("line"))
        .groupBy("host_key", "line")
        .agg(F.count_distinct("page").alias("with_line"))
        .where(F.col("with_line") >= min_pages)
        .join(totals, "host_key")
        .where(F.col("with_line") > F.lit(max_ratio) * F.col("pages"))
        .groupBy("host_key")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    dropped_col: str | None = None,
) -> DataFrame:
    """``docs`` without boilerplate lines; ``dropped_col``, a new name, adds how many a row lost."""
    host, lines, own, kept = unused(docs, "host_key", "boilerplate_lines", "own_boilerplate", "kept_lines")
    drops = materialise(boilerplate(docs, host_col, text_col, max_ratio, min_pages), "boilerplate")
    drops = drops.select(F.col("host_key").alias(host), F.col("lines").alias(lines))
    all_lines = _lines(F.col(text_col))
    keep = F.filter(
        all_lines, lambda x: ~F.array_contains(F.col(own), _key(x)) | (F.btrim(x, F.lit(BLANKS)) == "")
    )
    rows = docs.withColumn(host, _host(F.col(host_col))).join(drops, host, "left")
    # What a page has of its host's list, by hashing, is a few lines to compare each of its own with.
    rows = rows.withColumn(own, F.array_intersect(F.transform(all_lines, _key), F.col(lines)))
    rows = rows.withColumn(kept, F.when(F.size(own) > 0, keep))
    cleaned = F.when(F.col(kept).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    lost = F.when(F.col(kept).isNull(), F.lit(0)).otherwise(F.size(all_lines) - F.size(kept)).cast("long")
    columns = [cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*columns, *([lost.alias(dropped_col)] if dropped_col else []))
