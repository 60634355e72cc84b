"""Site-relative line dedup (operator 4). DataFrame functions only.

For every site, the pages that hold a line are counted and divided by the pages
of the site; lines above ``max_ratio`` are boilerplate there and are cut out of
the site's pages.

A line is known by two hashes (64 and 32 bits) and its length, so that no line text is shuffled.
Counts combine on the map side, hence a site with a third of all pages sends at
most one row a line and task. A site has at most (mean lines a page) / max_ratio
boilerplate lines, as their shares add up to no more than the lines of a page:
the per-site lists joined to the pages are bounded whatever the number of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genenet_spark.llm.common import freeze

#: A line in more than this share of a site's pages is boilerplate (production value).
MAX_RATIO = 0.05


def _key(line: Column) -> Column:
    """A line as counted: without white space at its ends. Blank lines have no key."""
    bare = F.trim(F.replace(F.replace(line, F.lit("\r"), F.lit(" ")), F.lit("\t"), F.lit(" ")))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b"), F.length(bare).alias("n")))


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, site_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """``site, line, pages, site_pages`` of every line above the ratio; ``line`` is its key."""
    rows = pages.select(F.col(site_col).alias("site"), F.col(text_col).cast("string").alias("text")).where("site IS NOT NULL")
    totals = rows.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    keys = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), _key), lambda k: k.isNotNull()))
    counts = rows.select("site", F.explode(keys).alias("line")).groupBy("site", "line").agg(F.count(F.lit(1)).alias("pages"))
    # Two pages at least: a line of one page is no repetition, whatever the ratio says.
    return counts.where("pages > 1").join(totals, "site").where(F.col("pages") > F.lit(max_ratio) * F.col("site_pages"))


def drop_boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, site_col: str = "source",
                     text_col: str = "text") -> DataFrame:
    """The input rows and columns with boilerplate lines cut from ``text_col``, plus ``lines`` and ``lines_cut`` (long).

    Every row stays, also one that loses all its lines (its text becomes empty). Cases: null text stays null
    with 0 lines, empty text has one (blank) line; rows of null site and of sites with one row keep their
    lines, any larger site is treated alike; blank lines are never cut; repeated rows are pages of their own; a line that occurs
    twice on a page counts as one page and is cut at both places; an empty table gives an empty result.
    The names ``__cut_*`` are taken for the join, and columns named ``lines`` or ``lines_cut`` are replaced by the
    results; any other extra column passes through.
    """
    lists = boilerplate(pages, max_ratio, site_col, text_col).groupBy("site").agg(F.collect_list("line").alias("__cut_list"))
    # Stored, so that the join knows the size: broadcast where small, else a join that splits a hot site.
    lists = freeze(lists.withColumnRenamed("site", "__cut_site"), "boilerplate")
    joined = pages.join(lists, pages[site_col] == lists["__cut_site"], "left").drop("__cut_site")
    every = F.split(F.col(text_col), "\n", -1)
    left = F.filter(every, lambda line: ~F.coalesce(F.array_contains(F.col("__cut_list"), _key(line)), F.lit(False)))
    joined = joined.withColumn("__cut_left", F.when(F.col("__cut_list").isNull(), every).otherwise(left))
    return joined.withColumns({
        text_col: F.array_join("__cut_left", "\n"),
        "lines": F.coalesce(F.size(every), F.lit(0)).cast("long"),
        "lines_cut": F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(every) - F.size("__cut_left")).cast("long"),
    }).drop("__cut_left", "__cut_list")
