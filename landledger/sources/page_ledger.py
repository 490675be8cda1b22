"""Ledger of landed feature pages: which records each holds, and whether together they hold all of them once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHOWN = 10  # problems named in an error


def page_ledger(pages: DataFrame) -> DataFrame:
    """(page, first, n, after, more): offset of a page's first record, its records, the offset after them, and whether
    the service had more.

    ``pages`` has page (path of its file), features and exceededTransferLimit. The offset is the number of the folder
    ``first=...`` that holds the file, else the last number in the file's name; a name without one gives null. A page without
    features holds none.
    """
    named = F.regexp_extract("page", r"first=(\d+)/[^/]*$", 1), F.regexp_extract("page", r"(\d+)[^\d/]*$", 1)
    first = F.coalesce(*[F.nullif(n, F.lit("")) for n in named]).try_cast("long")
    n = F.coalesce(F.size("features"), F.lit(0)).cast("long")
    return pages.select(
        "page", first.alias("first"), n.alias("n"), (first + n).alias("after"),
        F.coalesce("exceededTransferLimit", F.lit(False)).alias("more"),
    )


def ledger_problems(ledger: DataFrame) -> DataFrame:
    """(offset, problem, page): what keeps the pages from being one sequence that starts at 0; no row if nothing does.

    Pages follow each other where one begins at the offset after another's last record, so holes, overlaps and short
    pages are found by joins on offsets, whatever the size of a page; no task sees the whole sequence. Two
    pages with one offset overlap. A hole is named where it begins. Empty pages may stand at the end only, and unless one
    does, the last page must not say that there are more records.
    """
    held = ledger.filter("first IS NOT NULL AND n > 0")
    end = held.agg(F.coalesce(F.max("after"), F.lit(0)).alias("end"))  # one row
    starts = held.groupBy("first").agg(F.count(F.lit(1)).alias("pages"), F.min("page").alias("page"), F.max("n").alias("n"))
    broken = (
        held.join(starts.select(F.col("first").alias("after")), "after", "left_anti")
        .crossJoin(F.broadcast(end)).filter(F.col("after") < F.col("end"))
    )
    # a page that begins within another one lies in the same or the next run of the largest page's length
    size = F.broadcast(held.agg(F.greatest(F.max("n"), F.lit(1)).alias("size")))
    run = lambda c: F.floor(F.col(c) / F.col("size")).cast("long")
    inside = (
        broken.crossJoin(size).select("page", "first", "after", F.explode(F.array(run("first"), run("first") + 1)).alias("run"))
        .join(starts.select(F.col("first").alias("other")).crossJoin(size).withColumn("run", F.floor(F.col("other") / F.col("size")).cast("long")), "run")
        .filter("other > first AND other < after")
    )
    problem = lambda rows, offset, text: rows.select(
        F.col(offset).cast("long").alias("offset"), F.lit(text).alias("problem"), "page"
    )
    overlaps = inside.groupBy("first", "after", "page").agg(F.min("other").alias("other"))
    # an empty page after the last records settles that there are no more
    more = held.filter("more").join(ledger.filter("n = 0").select(F.col("first").alias("after")), "after", "left_anti")
    found = [
        problem(ledger.filter("first IS NULL"), "first", "no offset in the name"),
        problem(starts.filter("pages > 1"), "first", "more than one page begins here"),
        problem(overlaps, "other", "a page begins inside this one"),
        problem(broken.join(overlaps, ["first", "after", "page"], "left_anti"), "after", "no page begins where this one ends"),
        problem(end.join(starts.filter("first = 0"), F.lit(True), "left_anti").filter("end > 0").select(F.lit(0).alias("o"), F.lit(None).cast("string").alias("page")), "o", "no page begins here"),
        problem(ledger.filter("n = 0").crossJoin(F.broadcast(end)).filter(F.col("first") != F.col("end")), "first", "an empty page that is not the end"),
        problem(more.crossJoin(F.broadcast(end)).filter("after = end"), "after", "the service had more records"),
    ]
    whole = found[0]
    for rows in found[1:]:
        whole = whole.unionAll(rows)
    return whole


def check_ledger(ledger: DataFrame) -> None:
    """Raise with the first problems of a ledger, by offset."""
    shown = ledger_problems(ledger).orderBy(F.col("offset").asc_nulls_first(), "problem", "page").take(SHOWN)
    if shown:
        raise ValueError("feature pages are not one sequence: " + "; ".join(f"offset {r.offset}: {r.problem} ({r.page})" for r in shown))
