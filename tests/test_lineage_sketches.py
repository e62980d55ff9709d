"""Lineage bits, stored sketches and schema history on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.operators import lineage, sketches
from terrace.operators.lineage import Hop
from terrace.sources import history
from tests.conftest import plan_of, rows_of

DDL = "k string, a string, b int"


def hops(frame, raw, silver, gold):
    up, col = F.upper("a"), F.col
    return [Hop("raw", frame(DDL, *raw), col("k"), expected=[up, col("b")]),
            Hop("silver", frame(DDL, *silver), col("k"), [col("a"), col("b")], [col("b") * 2]),
            Hop("gold", frame(DDL, *gold), col("k"), [col("b")])]


GOOD = ([("1", "x", 1), ("2", "y", 2), ("3", None, None)], [("1", "X", 1), ("2", "Y", 2), ("3", None, None)],
        [("1", "", 2), ("2", "", 4), ("3", "", None)])


def test_whole_lineage(frame):
    traced = lineage.trace(hops(frame, *GOOD))
    assert rows_of(traced) == [(k, 63) for k in "123"]
    assert rows_of(lineage.patterns(traced, ["raw", "silver", "gold"], "e")) == [("e", "raw= silver= gold=", 3)]
    assert lineage.broken(traced, ["raw", "silver", "gold"]).count() == 0
    assert plan_of(traced).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2


def test_the_first_layer_sends_one_row_a_key(frame):
    plan = plan_of(lineage.trace(hops(frame, *GOOD))).split("Initial Plan")[-1]
    assert "struct(hop, 1" in plan and "struct(hop, 0" not in plan
    assert rows_of(lineage.trace([Hop("only", frame(DDL, ("1", "x", 1)), F.col("k"))])) == [("1", 3)]


@pytest.mark.parametrize("layer,change,bits,found", [
    (1, None, 63 - 4 - 8 - 32, ("silver", "missing")),
    (1, ("2", "y", 2), 63 - 8, ("silver", "different")),
    (2, None, 63 - 16 - 32, ("gold", "missing")),
    (2, ("2", "", 5), 63 - 32, ("gold", "different")),
    (0, ("2", "z", 2), 63 - 8, ("silver", "different")),
])
def test_a_damaged_hop_shows_in_its_bit(frame, layer, change, bits, found):
    layers = [list(x) for x in GOOD]
    layers[layer][1:2] = [change] if change else []
    traced = lineage.trace(hops(frame, *layers))
    assert dict(rows_of(traced)) == {"1": 63, "2": bits, "3": 63}
    assert rows_of(lineage.broken(traced, ["raw", "silver", "gold"])) == [("2", *found)]


def test_copies_and_nulls_in_lineage(frame):
    raw, silver, gold = (list(x) for x in GOOD)
    raw += [("1", "old", 7)] * 3 + [(None, "x", 1)]  # an earlier state of a key that was sent again
    gold += [("9", "", 1)]
    assert dict(rows_of(lineage.trace(hops(frame, raw, silver, gold)))) == {"1": 63, "2": 63, "3": 63, "9": 16}
    empty = lineage.trace(hops(frame, [], [], []))
    assert empty.count() == 0


def test_stored_sketches_merge_over_days_and_groups(spark, frame, tmp_path):
    draw = random.Random(1)
    rows = [(f"2024-{1 + i % 4:02}-{1 + i % 9:02}", "ab"[i % 2], draw.randrange(6000), draw.random() ** 3) for i in range(40_000)]
    df = spark.createDataFrame(rows, "d string, g string, id int, x double").withColumn("d", F.col("d").cast("date"))
    path = str(tmp_path / "s")
    sketches.store_daily(df, path, "d", ["g"], ["id"], ["x"])
    stored = spark.read.parquet(path)
    assert stored.count() == 36 * 2 // 2 and stored.agg(F.sum("n")).first()[0] == len(rows)
    shares = [0.05, 0.5, 0.95]

    def answers(part):
        return part.select("g", "n", sketches.distinct_of("id").alias("distinct"),
                           sketches.quantiles_of("x", shares).alias("quantiles"))
    judged = sketches.within_bounds(answers(sketches.merged(stored, ["g"])), df, ["g"], "id", "x", shares)
    exact = {g: len({r[2] for r in rows if r[1] == g}) for g in "ab"}
    assert rows_of(judged) == [(g, 20_000, exact[g], True, True) for g in "ab"]
    # An answer outside its bound is told.
    wrong = answers(sketches.merged(stored, ["g"])).withColumns(
        {"distinct": F.col("distinct") * 1.1, "quantiles": F.transform("quantiles", lambda q: q * 1.3)})
    assert rows_of(sketches.within_bounds(wrong, df, ["g"], "id", "x", shares), "distinct_within", "quantiles_within") == [
        (False, False)] * 2
    # A month that is sent again replaces its sketches only.
    sketches.store_daily(df.filter("month(d) = 2"), path, "d", ["g"], ["id"], ["x"])
    assert spark.read.parquet(path).agg(F.sum("n")).first()[0] == len(rows)


def test_sketches_of_nulls(frame):
    made = sketches.sketched(frame("g string, x double", ("a", None), ("b", 1.0), ("b", None)), ["g"], ["x"], ["x"])
    got = made.select("g", "n", sketches.distinct_of("x"), sketches.quantiles_of("x", [0.5]))
    assert rows_of(got.filter("g = 'b'")) == [("b", 2, 1, [1.0])]


def test_schema_drift_between_loads(spark, frame, tmp_path):
    path = str(tmp_path / "h")
    one = frame("a int, b string, c double", (1, "x", None))
    history.store_schema({"t": one, "gone": one}, path, "1")
    history.store_schema({"t": one}, path, "1b")
    history.store_schema({"t": one.select("c", "b", F.col("a").cast("long").alias("a"), F.lit(1).alias("d"))}, path, "2")
    history.store_schema({"t": one.drop("b")}, path, "3")
    history.store_schema({"t": one.drop("b")}, path, "3")
    kept = spark.read.parquet(path)
    assert kept.count() == 6 + 3 + 4 + 2
    assert rows_of(history.drift(kept, "1", "1b")) == []
    assert rows_of(history.drift(kept, "1b", "2").fillna("-")) == [
        ("t", "a", "retyped", "int", "bigint", 1), ("t", "c", "moved", "3", "1", 0), ("t", "d", "added", "-", "int", 1)]
    assert rows_of(history.drift_over(kept, ["1", "2", "3"]).select("load_id", "column_name", "change")) == [
        ("2", "a", "retyped"), ("2", "c", "moved"), ("2", "d", "added"),
        ("3", "a", "retyped"), ("3", "b", "dropped"), ("3", "c", "moved"), ("3", "d", "dropped")]
    contract = history.contract_rows(kept.select("load_id", "table_name", "position", "column_name", "data_type", "known_values"),
                                     {"t": one.schema})
    both = kept.unionByName(contract)
    assert rows_of(history.drift(both, history.CONTRACT, "3").select("column_name", "change")) == [
        ("b", "dropped"), ("c", "moved")]
