"""Hot keys: a third of the rows under one key must not end in one task or change results."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from terrace.operators import history, rows
from terrace.operators import quality as Q
from terrace.streaming import streams
from tests.conftest import day, plan_of

N = 60_000


@pytest.fixture
def small_thresholds(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def facts(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(0, N, numPartitions=16).select(
        "id", hot.alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int"))
        .alias("d"), F.repeat(F.lit("x"), 40).alias("pad"))


def test_as_of_join_splits_the_hot_key(spark, facts, small_thresholds):
    keys = facts.select("k").distinct()
    versions = keys.select("k", F.lit("old").alias("v"), F.lit("2024-01-01").cast("date").alias(
        "effective_date"), F.lit("2024-01-31").cast("date").alias("expiry_date")).unionByName(
        keys.select("k", F.lit("new").alias("v"), F.lit("2024-02-01").cast("date").alias(
            "effective_date"), F.lit("9999-12-31").cast("date").alias("expiry_date")))
    joined = history.version_as_of(facts, versions, "k", "d", ["v"])
    result = joined.collect()
    assert "skew=true" in plan_of(joined)
    assert len(result) == N
    assert all((r.v == "old") == (r.d <= day("2024-01-31")) for r in result)


def test_lookup_splits_the_hot_key_of_a_grouped_side(facts, small_thresholds):
    side = facts.groupBy("k").agg(F.count("*").alias("n"))  # already partitioned by the key
    joined = rows.lookup(facts, side, "k")
    assert {r.k: r.n for r in joined.collect()}["hot"] == N // 3
    assert "skew=true" in plan_of(joined)
    assert joined.columns == ["id", "k", "d", "pad", "n"]


def test_dedup_sends_one_hot_row_per_task(facts):
    kept = rows.dedup_latest(facts, ["k"], [F.col("id").desc()])
    assert {r.k: r.id for r in kept.collect()}["hot"] == N - 3
    plan = plan_of(kept)
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") < plan.rindex("WindowGroupLimit")


def test_referential_counts_before_it_joins(facts):
    parent = facts.select("k").filter("k <> 'hot'").distinct()
    (result,) = Q.referential(facts, parent, "k", "k", "t").collect()
    assert result.failed_rows == N // 3 and not result.passed


def test_stream_keeps_one_of_many_copies(spark, facts, tmp_path):
    copies = facts.select("k", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"))
    copies.write.parquet(str(tmp_path / "in"))
    arriving = streams.read_stream(spark, str(tmp_path / "in"), copies.schema)
    kept = streams.drop_resent(arriving, ["k"], "ts", "1 day", streams.file_block())
    streams.store_all_available(kept, str(tmp_path / "out"), str(tmp_path / "marks"), 300)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == stored.select("k").distinct().count() == copies.distinct().count()


def test_random_days_of_changes_equal_a_plain_simulation(spark):
    """Versions after several random loads, against the rules applied row by row in Python."""
    rng, ddl = random.Random(3), "k string, city string, phone string"
    state: dict[str, list[list]] = {}
    versions, today = None, day("2024-01-01")
    for _ in range(4):
        batch = [(f"k{i}", rng.choice(["a", "b", None]), rng.choice(["1", None]))
                 for i in range(12) if rng.random() < 0.6]
        df = spark.createDataFrame(batch, ddl)
        if versions is None:
            versions = history.open_versions(df, "k", "sk", today)
            for k, city, phone in batch:
                state[k] = [[city, phone, today, day("9999-12-31")]]
        else:
            versions = history.scd2_merge(versions, df, "k", "sk", ["city", "phone"], today)
            versions = spark.createDataFrame(versions.collect(), versions.schema)
            for k, city, phone in batch:
                known = state.setdefault(k, [])
                if known and known[-1][:2] == [city, phone]:
                    continue
                if known and known[-1][2] == today:
                    known.pop()
                elif known:
                    known[-1][3] = today - timedelta(days=1)
                known.append([city, phone, today, day("9999-12-31")])
        today += timedelta(days=rng.choice([0, 3, 10]))
    expected = {(k, *v) for k, vs in state.items() for v in vs}
    got = {(r.k, r.city, r.phone, r.effective_date, r.expiry_date) for r in versions.collect()}
    assert got == expected
    assert all(r.passed for r in Q.version_invariants(versions, "t", "k", "sk").collect())
