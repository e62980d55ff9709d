"""URL filters by a temporal list join.

Lists change: an entry is added on a date and may be taken off and put on again. Dated entries become
intervals (from an addition to the next entry of the same list, kind and pattern), and every capture
is judged by the entries that were active when it was fetched, whatever the lists say today.

Kinds of entry: `host` (that host), `domain` (that host and all below it) and `prefix` (host and the
first segments of the path). A capture asks for its host, each of its domains and each prefix of its
path, so the join is on equality, with the interval as a further condition: an as-of join, since at
most one interval of a list, kind and pattern holds a date. A host with very many captures makes a
skewed partition of that join, which adaptive execution splits; what a capture has matched is then
gathered by capture.

Everything is DataFrame functions. Defined results for odd input: a null or unreadable URL has the
empty host, which matches nothing but an entry for the empty host; a null fetch date matches
nothing; an addition and a removal on one date count as a removal; repeated entries are one; entries
with nulls are without effect; repeated captures are judged each; empty lists block nothing. Other columns
of the captures come back in the struct `row`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.texts import free_name

ENTRY = ("list", "kind", "pattern")


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.rtrim(F.lower(found), F.lit("."))


def segments(url: Column) -> Column:
    """The parts of the path between slashes, without empty ones."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def domains(name: Column) -> Column:
    """A host and everything above it, the longest first."""
    labels = F.split(name, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))


def prefixes(name: Column, parts: Column) -> Column:
    """Host and the first segments of the path, from one segment on."""
    return F.transform(parts, lambda _, i: F.concat(name, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i + 1), "/")))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, since, until) from (list, kind, pattern, added, at); an open end is null."""
    dated = (entries.dropna(subset=[*ENTRY, "added", "at"]).groupBy(*ENTRY, "at")
             .agg(F.min("added").alias("added")))  # false is less: the removal stands
    following = F.lead("at").over(W.partitionBy(*ENTRY).orderBy("at"))
    return dated.select(*ENTRY, "added", F.col("at").alias("since"), following.alias("until")).filter(
        "added").drop("added")


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """(row, host, matches): each capture, and the entries active when it was fetched, sorted."""
    row = F.struct(*(F.col(f"`{c}`") for c in captures.columns)).alias("row")
    known = captures.select(row, host(F.col(f"`{url}`")).alias("host"), segments(F.col(f"`{url}`")).alias("parts"),
                            F.col(f"`{fetched}`").alias("at"), F.monotonically_increasing_id().alias("n"))
    asked = known.select("n", "row", "host", "at", F.explode(F.concat(
        F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern"))),
        F.transform(domains(F.col("host")), lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("pattern"))),
        F.transform(prefixes(F.col("host"), F.col("parts")),
                    lambda p: F.struct(F.lit("prefix").alias("kind"), p.alias("pattern"))))).alias("ask")).select(
        "n", "row", "host", "at", "ask.kind", "ask.pattern")
    active = intervals(entries)
    hit = asked.join(active, (asked["kind"] == active["kind"]) & (asked["pattern"] == active["pattern"])
                     & (asked["at"] >= active["since"]) & (active["until"].isNull() | (asked["at"] < active["until"])),
                     "left")
    match = F.when(active["list"].isNotNull(), F.struct(active["list"], active["kind"], active["pattern"], active["since"]))
    return hit.groupBy("n").agg(
        F.any_value("row").alias("row"), F.any_value("host").alias("host"),
        F.array_sort(F.collect_list(match)).alias("matches")).drop("n")


def allowed(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """The captures that no active entry matches, with the columns they came with."""
    name = free_name(captures, "matches")
    kept = judged(captures, entries, url, fetched).withColumnRenamed("matches", name).filter(F.size(name) == 0)
    return kept.select(*(F.col("row")[c].alias(c) for c in captures.columns))
