"""Dated URL lists: every capture is judged by the list entries that were active on the day of its fetch.

An entry adds a pattern to a list, or removes it, on a day. The changes of one pattern on one list become validity
intervals, from the day of an addition to that of the next change. A pattern is a domain (``example.org``; it and all
below it) or a domain and leading path segments (``example.org/a/b``). Captures are reduced to different (URL, day)
before anything is shuffled, and their patterns to different (pattern, day), so a host that a third of all captures
share is a few rows in the as-of join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and closing dot; empty for what is no absolute URL."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]+)", 1)
    return F.lower(F.regexp_replace(found, r"\.$", ""))


def segments_of(url: Column) -> Column:
    """Non-empty segments of the path."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def patterns_of(url: Column) -> Column:
    """All patterns that cover a URL: the host, its parents of two labels or more, and the host with leading segments."""
    host, segments = host_of(url), segments_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(segments), F.lit(1))), lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), k), "/")))
    below = F.when(F.size(segments) > 0, prefixes).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(parents, below)))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, since, until): when a pattern is on a list; ``until`` is the first day on which it no longer is, null for never.

    ``entries``: list, pattern, day, added. Several changes on one day leave the pattern on the list if any adds it. Entries without
    list, pattern, day or action are left out, and repeated ones count once.
    """
    known = entries.where("list is not null and pattern is not null and day is not null and added is not null")
    # One row for each day of a pattern, merged before the shuffle: what a window holds is bounded by days.
    changes = known.groupBy("list", F.lower("pattern").alias("pattern"), "day").agg(F.max("added").alias("added"))
    later = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return changes.withColumn("until", later).where("added").select("list", "pattern", F.col("day").alias("since"), "until")


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day", allow: str | None = None) -> DataFrame:
    """``captures`` with lists (sorted names of the lists on which the URL was that day), n_entries and blocked.

    ``blocked``: on a list other than ``allow`` and not on ``allow``. A capture with a null or unreadable URL or a null day is on no
    list. Repeated captures each get a row. Other columns travel along, whatever their names; one named lists, n_entries or blocked
    gives way to the new one.
    """
    active = intervals(entries)
    seen = captures.select(F.col(url).alias("__url"), F.col(day).alias("__day")).where("__url is not null and __day is not null").distinct()
    spread = seen.select("__url", "__day", F.explode(patterns_of(F.col("__url"))).alias("pattern"))
    probes = spread.select("pattern", "__day").distinct()
    inside = (F.col("since") <= F.col("__day")) & (F.col("until").isNull() | (F.col("__day") < F.col("until")))
    on = probes.join(active, "pattern").where(inside).groupBy("pattern", "__day").agg(F.collect_set("list").alias("names"))
    verdict = spread.join(on, ["pattern", "__day"]).groupBy("__url", "__day").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("names")))).alias("__lists"), F.sum(F.size("names")).alias("__entries")
    )
    out = captures.join(verdict, (F.col(f"`{url}`") == F.col("__url")) & (F.col(f"`{day}`") == F.col("__day")), "left")
    lists = F.coalesce("__lists", F.array().cast("array<string>"))
    others = F.size(F.array_except(lists, F.array(F.lit(allow)))) > 0 if allow else F.size(lists) > 0
    free = F.array_contains(lists, allow) if allow else F.lit(False)
    kept = [out[f"`{c}`"] for c in captures.columns if c not in ("lists", "n_entries", "blocked")]
    return out.select(*kept, lists.alias("lists"), F.coalesce("__entries", F.lit(0)).cast("long").alias("n_entries"), (others & ~free).alias("blocked"))
