"""Boilerplate lines by their frequency within a site; DataFrame functions only.

A line is boilerplate of a host when more than ``ratio`` of the host's pages hold it and at least ``min_pages`` do.
Pages are counted, not occurrences.  Lines are counted under two independent 64-bit hashes, so no text is shuffled for
the counts; the partial aggregate leaves at most one row per task for a line that a third of all pages share, and the
join that finds a page's boilerplate lines is a plain equi-join, which AQE splits at a hot (host, line).

Defined results: a null host is a host of its own; a null text stays null and counts as a page without lines; blank
lines are never counted or dropped; lines are cut at ``\\n`` alone and compared exactly; repeated rows are pages each;
other columns are kept.  ``drop_boilerplate_lines`` adds the columns ``n_lines`` and
``n_dropped``, unless the pages have columns of these names, which then stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import aside

RATIO = 0.1
MIN_PAGES = 4


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _code(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate_lines(pages: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line code) of every boilerplate line."""
    totals = pages.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("_pages"))
    counts = (
        pages.select(F.col(host).alias("_host"), F.explode(F.array_distinct(_lines(F.col(text)))).alias("_line"))
        .filter(F.trim("_line") != "")
        .select("_host", _code(F.col("_line")).alias("_code"))
        .groupBy("_host", "_code")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= min_pages)
    )
    shared = counts.join(totals.withColumnRenamed("_host", "_of"), F.col("_host").eqNullSafe(F.col("_of")))
    return shared.filter(F.col("_n") > F.col("_pages") * F.lit(ratio)).select("_host", "_code")


def drop_boilerplate_lines(
    pages: DataFrame, key: str, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The pages with their boilerplate lines taken out of ``text``.

    What is flagged belongs to (host, line), so pages that share a key may share the list of flagged lines.
    """
    named, back = aside(pages, ("_key", "_host", "_drop", "_bad", "_bad_host", "_line", "_code", "n_lines", "n_dropped"))
    bad = boilerplate_lines(pages, host, text, ratio, min_pages).select(
        F.col("_host").alias("_bad_host"), F.col("_code").alias("_bad")
    )
    seen = (
        named.select(
            F.col(key).alias("_key"),
            F.col(host).alias("_host"),
            F.explode(F.array_distinct(_lines(F.col(text)))).alias("_line"),
        )
        .filter(F.trim("_line") != "")
        .select("_key", "_host", _code(F.col("_line")).alias("_code"))
    )
    flagged = (
        seen.join(bad, F.col("_host").eqNullSafe(F.col("_bad_host")) & (F.col("_code") == F.col("_bad")))
        .groupBy("_key", "_host")
        .agg(F.collect_set("_code").alias("_drop"))  # distinct lines of one page
    )
    joined = named.join(flagged, F.col(key).eqNullSafe(F.col("_key")) & F.col(host).eqNullSafe(F.col("_host")), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda line: ~F.array_contains(F.col("_drop"), _code(line)) | (F.trim(line) == ""))
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    left = F.when(F.col("_drop").isNull(), lines).otherwise(kept)
    out = joined.select(
        *[F.array_join(left, "\n").alias(c) if c == text else F.col(c) for c in named.columns],
        F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(n_lines - F.size(left)).cast("long").alias("n_dropped"),
    )
    clash = [c for c in ("n_lines", "n_dropped") if c in pages.columns]
    return out.drop(*clash).withColumnsRenamed(back)
