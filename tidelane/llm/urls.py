"""URL lists as they stood when a page was fetched, with DataFrame operations only.

Dated list entries (a list's name, a key, ``add`` or ``remove``, a date) become intervals in which the key is on the list:
from the day it is added up to the day before it is removed. A URL is looked up under all keys that cover it: its host
and each parent domain, and the host with each leading stretch of its path, as far as the lists have keys of such a depth. Captures meet the intervals of their keys,
salted by the capture, and those that hold the day of the fetch count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.llm.frames import unused


def intervals(entries: DataFrame) -> DataFrame:
    """``list, key, since, until`` (until is exclusive; null: still listed) from ``list, key, action, day``.

    Keys are compared in lower case. Entries with a null in any column, or another action, are ignored; repeated ones
    count once. When one day both adds and removes a key, it is removed. Adding a listed key again changes nothing.
    """
    clean = entries.where("action IN ('add', 'remove')").select("list", F.lower("key").alias("key"), F.col("day").cast("date").alias("day"), (F.col("action") == "remove").alias("off"))
    # At most one row a day for each key, whatever the number of entries.
    daily = clean.dropna().groupBy("list", "key", "day").agg(F.max("off").alias("off"))
    order = Window.partitionBy("list", "key").orderBy("day")
    turns = daily.withColumn("before", F.lag("off").over(order)).where("before IS NULL OR before != off")
    return turns.withColumn("until", F.lead("day").over(order)).where("NOT off").select("list", "key", F.col("day").alias("since"), "until")


def _after_scheme(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(url.cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://|[?#][\s\S]*$", "")


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; '' if there is none."""
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(_after_scheme(url), "/", 2), 1), "^.*@", ""), r"\.?(:[0-9]*)?$", "")


def _path_of(url: Column) -> Column:
    """The path's steps joined by single slashes, without query; '' if there are none."""
    steps = F.filter(F.split(F.coalesce(F.try_element_at(F.split(_after_scheme(url), "/", 2), F.lit(2)), F.lit("")), "/"), lambda x: x != "")
    return F.array_join(steps, "/")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def depth_of(key: Column) -> Column:
    """How a key covers URLs: by its host's last n labels (-n), or by its host and the first n steps of a path (n)."""
    return F.when(F.contains(key, F.lit("/")), _count(key, "/")).otherwise(-1 - _count(key, ".")).cast("int")


def with_keys(frame: DataFrame, url: str, into: str, depths: list[int] | None = None) -> DataFrame:
    """A row for each key that covers a URL: host and parent domains, and ``host/a``, ``host/a/b`` ... of its path.

    With ``depths``, only keys of these depths. Rows without host are left out. Each key is a row of its own, so a URL of very
    many labels or steps never has all its keys in memory at once.
    """
    host, path, depth = (unused(frame, name) for name in ("url_host", "url_path", "url_depth"))
    cut = frame.withColumns({host: host_of(F.col(url)), path: _path_of(F.col(url))}).where(F.col(host) != "")
    labels, steps = _count(F.col(host), ".") + 1, F.when(F.col(path) == "", 0).otherwise(_count(F.col(path), "/") + 1)
    every = F.filter(F.sequence(-labels, steps), lambda d: d != 0)
    if depths is not None:
        every = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda d: (d != 0) & (d >= -labels) & (d <= steps))
    key = f"IF(`{depth}` < 0, substring_index(`{host}`, '.', `{depth}`), concat(`{host}`, '/', substring_index(`{path}`, '/', `{depth}`)))"
    return cut.withColumn(depth, F.explode(every)).withColumn(into, F.expr(key)).drop(host, path, depth)


def listed(captures: DataFrame, entries: DataFrame, id_column: str = "page_id", salts: int = 16) -> DataFrame:
    """Each capture (``id_column``, ``url``, ``fetched`` a date) with the lists that held it on that day.

    Adds ``n_entries`` (list and key pairs active that day), ``lists`` (their names, sorted, comma-joined) and ``blocked``. A row for each distinct
    capture: repeated rows give one. A null URL, a URL without host or a null day is on no list. Other columns are ignored.
    """
    captures = captures.select(F.col(id_column).alias("id"), F.col("url"), F.col("fetched").cast("date").alias("fetched")).distinct()
    active = intervals(entries).withColumn("depth", depth_of(F.col("key")))
    # Small numbers: at most twice as many as the longest key has labels or steps.
    depths = sorted(r.depth for r in active.select("depth").distinct().collect())
    # A URL's digest stands for it in the join, however long it is.
    slim = captures.withColumn("sign", F.md5("url"))
    keyed = with_keys(slim, "url", "key", depths).select("id", "sign", "fetched", "key")
    keyed = keyed.withColumn("salt", F.pmod(F.xxhash64("id", "sign"), F.lit(salts)))
    spread = active.drop("depth").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    met = keyed.join(spread, ["key", "salt"]).where("since <= fetched AND (until IS NULL OR fetched < until)")
    found = met.groupBy("id", "sign", "fetched").agg(F.count("*").alias("n"), F.collect_set("list").alias("lists"))
    found = found.select(F.col("id").alias("i"), F.col("sign").alias("s"), F.col("fetched").alias("f"), "n", "lists")
    same = F.col("id").eqNullSafe(F.col("i")) & F.col("sign").eqNullSafe(F.col("s")) & F.col("fetched").eqNullSafe(F.col("f"))
    return slim.join(found, same, "left").select(
        F.col("id").alias(id_column), "url", "fetched", F.coalesce("n", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce(F.array_join(F.array_sort("lists"), ","), F.lit("")).alias("lists"), F.col("n").isNotNull().alias("blocked"),
    )
