"""Versioned dimensions, upserts, change classification, late arrivals, quarantine.

Parquet has no MERGE, so each function returns the complete new content of a table; the
caller writes it to a new folder and swaps. The merge and the classification first take one row
per key of either side, so their joins can't fan out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators.rows import dedup_latest, distinct_keys, drop_known, fresh_key, row_digest
from terrace.schemas import OPEN_END

VERSION_COLUMNS = ["effective_date", "expiry_date", "is_current"]


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def open_versions(df: DataFrame, key: str, sk: str, effective: date | str) -> DataFrame:
    """First versions for rows that have none yet."""
    since = F.lit(str(effective)).cast("date")
    return df.withColumns({
        "effective_date": since,
        "expiry_date": _open_end(),
        "is_current": F.lit("Y"),
        sk: C.surrogate_key(F.col(key), since.cast("string")),
    })


def scd2_merge(
    versions: DataFrame,
    incoming: DataFrame,
    key: str,
    sk: str,
    tracked: Sequence[str],
    effective: date | str,
) -> DataFrame:
    """Apply one day's conformed rows to a versioned dimension.

    New key: an open version. Changed tracked column: the version valid on that day ends the
    day before and a new one takes over the rest of its time. A second change on the same day
    replaces the version. Equal or absent: untouched. `incoming` has the attribute columns of
    `versions` without the version columns and the surrogate key; it may repeat keys, of which
    the latest wins. Applying the same input again changes nothing.

    The day may lie before later versions, which stay as they are; before the first version of
    a key, a closed version is put in front of it. So days may be loaded in any order and
    versions of a key still follow each other without a gap.

    Of each key one version is joined, the earliest that has not ended before the day; the
    others, which may be many for one key, pass straight through.
    """
    since = F.lit(str(effective)).cast("date")
    attributes = [c for c in versions.columns if c not in {key, sk, *VERSION_COLUMNS}]
    newest = dedup_latest(incoming.select(key, *attributes), [key])
    nth = F.row_number().over(Window.partitionBy(key).orderBy("effective_date", sk))
    ended_before = versions.filter(F.col("expiry_date") < since)
    ahead = versions.filter(F.col("expiry_date") >= since).withColumn("_nth", nth)
    passed = ended_before.unionByName(ahead.filter("_nth > 1").drop("_nth"))
    opened = ahead.filter("_nth = 1").select(
        F.col(key), F.struct(*versions.columns).alias("old"),
        C.tracked_hash(tracked).alias("old_hash"))
    arriving = newest.select(
        F.col(key), F.struct(*attributes).alias("new"), C.tracked_hash(tracked).alias("new_hash"))

    is_new = F.col("old").isNull() & F.col("new").isNotNull()
    is_change = F.col("old").isNotNull() & F.col("new").isNotNull() & (
        F.col("old_hash") != F.col("new_hash"))
    same_day = F.col("old.effective_date") == since
    earlier = F.col("old.effective_date") > since

    kept = F.struct(*(F.col(f"old.{c}").alias(c) for c in versions.columns))
    ended = F.struct(*(
        {"expiry_date": F.date_sub(since, 1), "is_current": F.lit("N")}.get(
            c, F.col(f"old.{c}")).alias(c)
        for c in versions.columns))
    started = {
        key: F.col(key),
        sk: C.surrogate_key(F.col(key), since.cast("string")),
        "effective_date": since,
    }
    until = {"expiry_date": F.coalesce(F.col("old.expiry_date"), _open_end()),
             "is_current": F.coalesce(F.col("old.is_current"), F.lit("Y"))}
    in_front = {"expiry_date": F.date_sub(F.col("old.effective_date"), 1), "is_current": F.lit("N")}

    def version(end: dict[str, Column]) -> Column:
        values = started | end
        return F.struct(*(values.get(c, F.col(f"new.{c}")).alias(c) for c in versions.columns))

    begun = version(until)

    merged = (
        opened.join(arriving, key, "full_outer")
        .select(F.explode(
            F.when(is_new | (is_change & same_day), F.array(begun))
            .when(is_change & earlier, F.array(version(in_front), kept))
            .when(is_change, F.array(ended, begun))
            .otherwise(F.array(kept))).alias("v"))
        .select("v.*")
    )
    return passed.unionByName(merged)


def scd1_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest attributes win: incoming over existing, and existing keys stay otherwise."""
    both = existing.withColumn("_arrival", F.lit(0)).unionByName(
        incoming.withColumn("_arrival", F.lit(1)))
    return dedup_latest(both, keys, [F.col("_arrival").desc()]).drop("_arrival")


def classify_changes(
    existing: DataFrame, incoming: DataFrame, key: str, compared: Sequence[str]
) -> DataFrame:
    """NEW, CHANGED, UNCHANGED or MISSING per key, and how many extra copies arrived."""
    # The copy of largest digest stands for a key: one grouping, combined in the map tasks.
    state = F.max_by(C.tracked_hash(compared), row_digest(compared))
    before = existing.groupBy(key).agg(state.alias("old_hash"))
    after = incoming.groupBy(key).agg(state.alias("new_hash"), F.count("*").alias("copies"))
    return before.join(after, key, "full_outer").select(
        key,
        F.when(F.col("old_hash").isNull(), "NEW")
        .when(F.col("new_hash").isNull(), "MISSING")
        .when(F.col("old_hash") != F.col("new_hash"), "CHANGED")
        .otherwise("UNCHANGED").alias("change"),
        F.greatest(F.coalesce("copies", F.lit(0)) - 1, F.lit(0)).cast("bigint")
        .alias("duplicate_rows"),
    )


def change_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("change").agg(
        F.count("*").alias("keys"), F.sum("duplicate_rows").alias("duplicate_rows"))


def append_unseen(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    partition: str | None = None,
    newest_first: Sequence[Column] = (),
) -> DataFrame:
    """Rows of a batch to append: ids not yet stored, one row per id, however old the event.

    With `partition`, a column both sides have and `existing` is stored by (such as the month
    of an immutable event date), only the partitions that the batch touches are read: their
    names, one for each month of the batch, are looked up first. An id sent with two dates is known
    if it is stored under either.
    """
    batch = dedup_latest(incoming, [key], newest_first)
    if partition is None:
        return drop_known(batch, existing, [key])
    names = [r[0] for r in distinct_keys(incoming, partition).collect()]
    touched = existing.filter(F.col(partition).isin([n for n in names if n is not None]))
    return drop_known(batch, touched, [key]).select(*incoming.columns)


def version_as_of(
    facts: DataFrame, versions: DataFrame, key: str, on_date: str, carried: Sequence[str]
) -> DataFrame:
    """Each fact with the version valid on its date (null if none).

    Equality on the key does the distribution and the date range filters inside the join. A
    key with very many facts has few versions, so its join partition is split over tasks.
    """
    side = versions.select(
        fresh_key(key).alias("_key"), F.col("effective_date").alias("_from"),
        F.col("expiry_date").alias("_to"), *carried)
    match = (F.col("_fact_key") == F.col("_key")) & facts[on_date].between(
        F.col("_from"), F.col("_to"))
    return facts.withColumn("_fact_key", fresh_key(key)).join(side, match, "left").drop(
        "_fact_key", "_key", "_from", "_to")


def version_gaps(versions: DataFrame, key: str) -> DataFrame:
    """Versions not followed on the next day by the next version of their key.

    Distinct (key, effective_date) rows first: a key then has at most one row per calendar
    day, which bounds the window however often versions were repeated.
    """
    spans = versions.groupBy(key, "effective_date").agg(F.max("expiry_date").alias("expiry_date"))
    w = Window.partitionBy(key).orderBy("effective_date")
    return (
        spans.withColumn("next_effective", F.lead("effective_date").over(w))
        .filter("next_effective IS NOT NULL AND next_effective <> date_add(expiry_date, 1)")
    )


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with the names of the rules they break; a null condition counts as not broken."""
    hits = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return df.withColumn("reasons", F.filter(F.array(*hits), lambda r: r.isNotNull()))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons)."""
    judged = with_reasons(df, rules)
    valid = judged.filter(F.size("reasons") == 0).drop("reasons")
    return valid, judged.filter(F.size("reasons") > 0)
