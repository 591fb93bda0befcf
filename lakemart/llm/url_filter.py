"""URL filter by dated lists: a temporal join, in DataFrame operations only.

A list entry says that from a day on a domain is listed (``add``) or no longer listed (``remove``).
Entries become validity intervals: for each list and domain, each ``add`` holds until the next entry.
A capture is judged by the entries active on its day for its host and every parent domain of it.

Captures are reduced to distinct (host, day) before the join and the verdicts are joined back, so a
host that holds a third of the captures meets the lists once a day. Entries of one day are reduced to
one (``remove`` wins), so a domain's window holds at most a row for each day. No hints: Spark
broadcasts a side only if its measured size allows, and splits skewed partitions otherwise.

Cases: a capture without url, host or day is kept with no active entry; hosts and domains are compared
in lower case without a final dot; repeated captures are judged one by one; repeated entries count
once; an ``add`` while listed changes nothing, nor does a ``remove`` while not listed; entries with a
null list, domain or day are ignored; empty tables give no rows or no active entries; extra columns
of the captures are kept, those with a name of the result under another (see ``judge``); extra columns of
the entries are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url):
    """Host of a URL column in lower case, without a final dot; null if there is none."""
    h = F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.$", "")
    return F.when(h != "", h)


def with_parents(host):
    """The host and each parent domain, as an array."""
    part = F.split(host, r"\.")
    return F.transform(part, lambda _, i: F.array_join(F.slice(part, i + 1, F.size(part)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, verdict, domain, since, until) from entries (list, verdict, domain, day, action); ``until`` is open or null."""
    keys = ["list", "verdict", "domain"]
    one = (entries.select("list", "verdict", F.regexp_replace(F.lower("domain"), r"\.$", "").alias("domain"), "day",
                          (F.col("action") == "remove").alias("gone"))
           .dropna(subset=["list", "domain", "day"]).groupBy(*keys, "day").agg(F.max("gone").alias("gone")))
    following = Window.partitionBy(*keys).orderBy("day")
    turns = one.withColumn("was", F.lag("gone").over(following)).where("was is null and not gone or was <> gone")
    return (turns.withColumn("until", F.lead("day").over(following)).where("not gone")
            .select(*keys, F.col("day").alias("since"), "until"))


ADDED = ("url_host", "n_active", "active_lists", "blocked")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with url_host, n_active, active_lists (sorted, comma-joined) and blocked.

    A capture is blocked if an active entry of a ``block`` list covers it and none of an ``allow`` list does. A
    column of the captures that has one of these names is kept with an underscore after it.
    """
    names = []
    for c in captures.columns:
        new = c
        while new != c and new in captures.columns or new in (*ADDED, *names):
            new += "_"
        names.append(new)
    own = lambda c: captures[f"`{c}`"]
    # the captures' own columns travel in one struct, so that none of their names can clash
    held = captures.select(F.struct(*[own(c).alias(n) for c, n in zip(captures.columns, names, strict=True)]).alias("capture"),
                           host_of(own(url)).alias("url_host"), own(day).alias("on"))
    seen = held.select("url_host", "on").dropna().distinct().withColumn("domain", F.explode(with_parents(F.col("url_host"))))
    valid = intervals(entries)
    hit = (seen.join(valid, "domain").where("since <= `on` and (until is null or `on` < until)")
           .groupBy("url_host", "on").agg(F.count(F.lit(1)).alias("n"), F.collect_set("list").alias("lists"),
                                         F.max(F.col("verdict") == "block").alias("block"),
                                         F.max(F.col("verdict") == "allow").alias("allow")))
    return held.join(hit, ["url_host", "on"], "left").select(
        "capture.*", "url_host", F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce(F.array_join(F.sort_array("lists"), ","), F.lit("")).alias("active_lists"),
        F.coalesce(F.col("block") & ~F.col("allow"), F.lit(False)).alias("blocked"))
