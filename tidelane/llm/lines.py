"""Line removal by site-relative frequency, with DataFrame operations only.

The pages of a site that hold a line are divided by all pages of the site; lines above a ratio are boilerplate. Lines are
known by their MD5. A page's dropped lines are gathered by (site, MD5 of the text), so equal pages share one entry and
only that list meets the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import unused


def _digest(x: Column) -> Column:
    return F.unhex(F.md5(x.cast("binary")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _line_digests(text: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), _digest))


def boilerplate(docs: DataFrame, site: str = "source", ratio: float = 0.1, least_pages: int = 5) -> DataFrame:
    """``site, line, pages, total`` for each line of a site that is boilerplate: its MD5, the pages that hold it, all pages."""
    place = F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site")
    counted = docs.select(place, F.explode(_line_digests(F.col("text"))).alias("line")).groupBy("site", "line").agg(F.count("*").alias("pages"))
    totals = docs.select(place).groupBy("site").agg(F.count("*").alias("total"))
    return counted.where(F.col("pages") >= least_pages).join(totals, "site").where(F.col("pages") > ratio * F.col("total"))


def drop_boilerplate(docs: DataFrame, into: str, site: str = "source", ratio: float = 0.1, least_pages: int = 5, keep_whole: bool = False) -> DataFrame:
    """``docs`` with ``text`` less its boilerplate lines, and a struct column ``into``: ``n_lines`` and ``n_dropped``.

    A line is what stands between line feeds; blank ones (spaces only) are never boilerplate. A line is dropped when more than ``ratio`` of
    the site's pages, and at least ``least_pages``, hold it. With ``keep_whole`` a page that would lose all its lines
    keeps them if another page of its site has the same text: a later stage then keeps one of the copies whole. Null texts stay null and count as pages; a null site is the
    site ''. Repeated rows are pages each. Other columns pass through; an earlier column ``into`` is replaced.
    """
    digest, place, gone = (unused(docs, name) for name in ("text_digest", "text_site", "gone_lines"))
    keyed = docs.withColumns({digest: _digest(F.coalesce(F.col("text").cast("string"), F.lit(""))), place: F.coalesce(F.col(site).cast("string"), F.lit(""))})
    own = keyed.select(place, digest, F.explode(_line_digests(F.col("text"))).alias("line"))
    bad = boilerplate(docs, site, ratio, least_pages).select(F.col("site").alias(place), "line")
    copied = unused(docs, "text_copied")
    lists = own.join(bad, [place, "line"]).groupBy(place, digest).agg(F.collect_set("line").alias(gone), F.count("*").alias(copied))
    lists = lists.select(F.col(place).alias("list_site"), F.col(digest).alias("list_digest"), gone, (F.col(copied) > F.size(gone)).alias(copied))  # a page has each of its lines once
    met = keyed.join(lists, (F.col(place) == F.col("list_site")) & (F.col(digest) == F.col("list_digest")), "left")
    lines = _lines(F.col("text"))
    stay = F.filter(lines, lambda x: ~F.array_contains(gone, _digest(x)))
    text = F.when(F.col(gone).isNull() | F.col("text").isNull(), F.col("text"))
    if keep_whole:
        text = text.when(F.col(copied) & (F.size(F.filter(stay, lambda x: F.trim(x) != "")) == 0), F.col("text"))
    text = text.otherwise(F.concat_ws("\n", stay))
    new = unused(docs, "new_text")
    counts = F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(_lines(F.col(new)))).cast("long").alias("n_dropped"))
    # An empty text and one whose lines are all gone both split into one line.
    emptied = F.col(gone).isNotNull() & F.col("text").isNotNull() & (F.size(stay) == 0) & (F.length(new) == 0)
    counts = F.when(emptied, F.struct(F.size(lines).cast("long").alias("n_lines"), F.size(lines).cast("long").alias("n_dropped"))).otherwise(counts)
    out = met.withColumn(new, text).withColumn(into, counts).withColumn("text", F.col(new))
    return out.select(*[c for c in docs.columns if c != into], into)
