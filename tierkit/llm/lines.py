"""Boilerplate lines by site-relative frequency, with DataFrame operations only.

Per host, the number of pages that contain a line is divided by the host's
number of pages; lines above the ratio are dropped from every page of that
host.  Lines are counted by their 64-bit hash after a partial aggregate, so a
line on every page of a hot host costs one row per task in the shuffle.  Whole
texts are shuffled only if the boilerplate table is too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.llm.scratch import keep
from tierkit.operators._names import q
from tierkit.operators.merge import broadcast_limit

RATIO = 0.1
#: A line of two pages says no more than that one is a copy of the other.
MIN_PAGES = 3
BLANK = " \t\r\x0b\x0c"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def _key(line: Column) -> Column:
    return F.xxhash64(_bare(line))


def boilerplate(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``(host, lines)``: per host the hashes of its boilerplate lines.

    A line is boilerplate if more than ``ratio`` of the host's pages, and at
    least ``min_pages`` of them, contain it.  A host has fewer such lines than
    its mean number of distinct lines per page divided by ``ratio``, so a row
    is bounded whatever the number of pages.
    """
    pages = docs.select(q(host_col).cast("string").alias("host"), F.split(q(text_col).cast("string"), "\n").alias("l"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    keys = F.array_distinct(F.transform(F.filter("l", lambda x: _bare(x) != ""), _key))
    counts = pages.select("host", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    often = counts.where(F.col("n") >= min_pages).alias("c").join(totals.alias("t"), F.expr("c.host <=> t.host"))
    return (
        often.where(F.col("n") > F.lit(ratio) * F.col("total"))
        .select("c.host", "line")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    lines_col: str | None = None,
    dropped_col: str | None = None,
) -> DataFrame:
    """All rows and columns of ``docs``, boilerplate lines cut from the text.

    Lines are split at ``\\n`` and compared without blanks at either end; the
    kept lines stay as they are, joined by ``\\n``.  Lines without text are
    neither counted nor dropped.  Null text stays null, empty stays empty, and
    a page of nothing but boilerplate becomes empty; no row is dropped.  Rows
    with a null host form one host of their own.  Repeated rows are pages like
    any other.  ``lines_col`` and ``dropped_col`` name optional counts (null
    text: 0); every other column passes through whatever its name.
    """
    found = keep(boilerplate(docs, host_col, text_col, ratio, min_pages), "boilerplate")
    size = found.agg(F.sum(F.size("lines") * 8 + F.octet_length(F.coalesce("host", F.lit(""))) + 64)).first()[0] or 0
    if size <= broadcast_limit(docs.sparkSession):
        found = F.broadcast(found)
    pages = docs.select(
        F.struct("*").alias("row"),
        q(host_col).cast("string").alias("page_host"),
        F.split(q(text_col).cast("string"), "\n").alias("all"),
    )
    joined = pages.join(found, F.expr("page_host <=> host"), "left")
    kept = F.when(F.col("lines").isNull(), F.col("all")).otherwise(
        F.filter("all", lambda x: (_bare(x) == "") | ~F.array_contains("lines", _key(x)))
    )
    done = joined.select("row", "all", kept.alias("kept"))
    out = [
        F.array_join("kept", "\n").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    n_all, n_kept = (F.coalesce(F.size(c), F.lit(0)) for c in ("all", "kept"))
    n_all, n_kept = (F.greatest(c, F.lit(0)).cast("long") for c in (n_all, n_kept))
    if lines_col:
        out.append(n_all.alias(lines_col))
    if dropped_col:
        out.append((n_all - n_kept).alias(dropped_col))
    return done.select(*out)
