import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrace.operators import series
from tests.conftest import rows_of

DDL = "series_id int, reading_ts timestamp, reading_id int, " + ", ".join(
    f"{s} double" for s in series.SENSORS) + ", fineness double"


@pytest.fixture(scope="module")
def readings(spark):
    """One series holds most rows, a few are short, and readings are missing or zero."""
    rng = random.Random(7)
    rows, start = [], datetime(2024, 1, 1)
    sizes = {1: 400, 2: 1, 3: 2, 4: 40, 5: 5}
    for sid, n in sizes.items():
        for i in range(n):
            values = [rng.choice([None, 0.0, rng.random() * 10]) for _ in series.SENSORS]
            rows.append((sid, start + timedelta(minutes=37 * i), i, *values, rng.random()))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DDL)


def expected(readings, back_fill):
    """The same features by pandas, series by series."""
    frames = []
    for _, g in readings.toPandas().groupby("series_id"):
        g = g.sort_values(["reading_ts", "reading_id"]).reset_index(drop=True)
        out = g.copy()
        for c in series.SENSORS:
            out[f"{c}_roll4_mean"] = g[c].rolling(2, min_periods=1).mean()
            out[f"{c}_roll8_mean"] = g[c].rolling(4, min_periods=1).mean()
            out[f"{c}_roll4_std"] = g[c].rolling(2, min_periods=1).std().fillna(0)
            out[f"{c}_diff"] = g[c].diff().fillna(0)
            out[f"{c}_lag1"], out[f"{c}_lag2"] = g[c].shift(1), g[c].shift(2)
        for n, (a, b) in series.PRODUCTS.items():
            out[n] = g[a] * g[b]
        for n, (a, b) in series.QUOTIENTS.items():
            out[n] = g[a] / g[b].replace(0, np.nan)
        numeric = [n for n in series.feature_names() if n not in series.TIME_FEATURES]
        if back_fill:
            out[numeric] = out[numeric].bfill()
        out[numeric] = out[numeric].ffill().fillna(0)
        frames.append(out[["series_id", "reading_id", *numeric]])
    return pd.concat(frames).sort_values(["series_id", "reading_id"]).reset_index(drop=True)


@pytest.mark.parametrize("chunks", [None, 1, 8, 40])
@pytest.mark.parametrize("back_fill", [False, True])
def test_features_equal_pandas_in_any_number_of_chunks(readings, chunks, back_fill):
    built = series.build_features(readings, chunks=chunks, back_fill=back_fill)
    assert set(series.feature_names()) <= set(built.columns) and len(series.feature_names()) == 69
    want = expected(readings, back_fill)
    got = built.select(*want.columns).toPandas().sort_values(
        ["series_id", "reading_id"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=1e-7)


def test_a_dominant_series_is_split_over_tasks(readings):
    split = series.Series.of(readings, ["series_id"], ["reading_ts", "reading_id"], chunks=8)
    sizes = [r["count"] for r in split.df.filter("series_id = 1").groupBy("_chunk").count().collect()]
    assert len(sizes) > 5 and max(sizes) <= 90


def test_decision(frame):
    df = frame("p double, w double", (9.0, 0.1), (5.0, 0.1), (7.0, 0.1), (9.0, 5.0), (None, 0.1))
    assert rows_of(df.select(series.decision("p", "w").alias("a"))) == [
        ("decrease separator fan",), ("hold",), ("hold",), ("increase separator speed",),
        ("operator review",)]


def test_outliers_and_split(readings):
    counts = series.outlier_counts(readings, "sound_level", 0.1).first()
    assert counts.kept + counts.removed == readings.count()
    assert series.outlier_filter(readings, "sound_level", 0.1).count() == counts.kept
    train, test = series.time_split(readings, "reading_ts", "2024-01-02 00:00:00")
    assert train.count() + test.count() == readings.count() and test.count() > 0
    assert train.agg(F.max("reading_ts")).first()[0] < test.agg(F.min("reading_ts")).first()[0]
