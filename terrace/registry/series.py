"""Registered queries: sensor series, features, regression."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators import models, series
from terrace.registry.common import Tables, query
from terrace.session import cut_lineage, new_folder
from terrace.streaming.streams import advise

KEYS, ORDER = ["series_id"], ["reading_ts", "reading_id"]
BOUNDARY = "2024-01-24 00:00:00"
LABEL = "fineness"


def _rounded(df: DataFrame, columns, places: int = 6) -> DataFrame:
    return df.select("series_id", "reading_id",
                     *(F.round(F.col(c).cast("double"), places).alias(c) for c in columns))


def _windowed(t: Tables, build, back: int = 3) -> DataFrame:
    names = list(build(series.Window.partitionBy("series_id").orderBy(*ORDER)))
    return _rounded(
        series.Series.of(t.readings, KEYS, ORDER).with_windows(back, build).result(), names)


def _over(expression: str, frame: str = "") -> str:
    return (f"{expression} OVER (PARTITION BY series_id ORDER BY reading_ts, reading_id {frame})")


def _per_sensor(template: str) -> str:
    return ", ".join(template.format(s=s) for s in series.SENSORS)


_LAST2 = "ROWS BETWEEN 1 PRECEDING AND CURRENT ROW"
_LAST4 = "ROWS BETWEEN 3 PRECEDING AND CURRENT ROW"
_ID = "SELECT series_id, reading_id, "

_MEANS = _per_sensor(
    "round(" + _over("avg({s})", _LAST2) + ", 6) AS {s}_roll4_mean, "
    "round(" + _over("avg({s})", _LAST4) + ", 6) AS {s}_roll8_mean")
_STDS = _per_sensor(
    "round(coalesce(" + _over("stddev_samp({s})", _LAST2) + ", 0), 6) AS {s}_roll4_std")
_DIFFS = _per_sensor("round(coalesce({s} - " + _over("lag({s}, 1)") + ", 0), 6) AS {s}_diff")
_LAGS = _per_sensor(", ".join(
    "round(" + _over(f"lag({{s}}, {k})") + f", 6) AS {{s}}_lag{k}" for k in (1, 2)))
_INTERACTIONS = ", ".join(
    [f"round({a} * {b}, 6) AS {n}" for n, (a, b) in series.PRODUCTS.items()]
    + [f"round({a} / nullif({b}, 0), 6) AS {n}" for n, (a, b) in series.QUOTIENTS.items()])
_TIME = """cast(hour(reading_ts) as int) AS hour, cast(isodow(reading_ts) - 1 as int) AS day_of_week,
  round(sin(2 * pi() * hour(reading_ts) / 24), 6) AS hour_sin,
  round(cos(2 * pi() * hour(reading_ts) / 24), 6) AS hour_cos"""


@query("ts_rolling_mean", f"{_ID}{_MEANS} FROM b_sensor_readings")
def rolling_mean(t: Tables) -> DataFrame:
    return _windowed(t, lambda w: {
        **series.rolling_mean(series.SENSORS, 2, w, "roll4_mean"),
        **series.rolling_mean(series.SENSORS, 4, w, "roll8_mean")})


@query("ts_rolling_std", f"{_ID}{_STDS} FROM b_sensor_readings")
def rolling_std(t: Tables) -> DataFrame:
    return _windowed(t, lambda w: series.rolling_std(series.SENSORS, 2, w, "roll4_std"), 1)


@query("ts_diff", f"{_ID}{_DIFFS} FROM b_sensor_readings")
def difference(t: Tables) -> DataFrame:
    return _windowed(t, lambda w: series.difference(series.SENSORS, w), 1)


@query("ts_lag", f"{_ID}{_LAGS} FROM b_sensor_readings")
def lag(t: Tables) -> DataFrame:
    return _windowed(t, lambda w: series.lags(series.SENSORS, (1, 2), w), 2)


_NEXT_KNOWN = ("first({s} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY reading_ts, "
               "reading_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
_LAST_KNOWN = ("last({s} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY reading_ts, "
               "reading_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


@query("ts_fill", f"{_ID}" + _per_sensor(
    f"round(coalesce({_NEXT_KNOWN}, {_LAST_KNOWN}, 0), 6) AS {{s}}") + " FROM b_sensor_readings")
def fill(t: Tables) -> DataFrame:
    return _rounded(series.Series.of(t.readings, KEYS, ORDER).fill(series.SENSORS).result(),
                    series.SENSORS)


@query("ts_interactions", f"{_ID}{_INTERACTIONS} FROM b_sensor_readings")
def interactions(t: Tables) -> DataFrame:
    names = [*series.PRODUCTS, *series.QUOTIENTS]
    return _rounded(t.readings.withColumns(series.interactions()), names)


@query("ts_cyclic_time", f"{_ID}{_TIME} FROM b_sensor_readings")
def cyclic_time(t: Tables) -> DataFrame:
    added = t.readings.withColumns(series.cyclic_time("reading_ts"))
    return added.select("series_id", "reading_id", "hour", "day_of_week",
                        F.round("hour_sin", 6).alias("hour_sin"),
                        F.round("hour_cos", 6).alias("hour_cos"))


_NUMERIC = [n for n in series.feature_names() if n not in series.TIME_FEATURES]
_FILLED = ", ".join(
    f"coalesce({_LAST_KNOWN.format(s=n)}, 0) AS {n}" for n in _NUMERIC)


@query("ts_feature_build", f"""
  SELECT series_id, reading_id, hour, day_of_week, hour_sin, hour_cos, {_FILLED}
  FROM (SELECT *, {_MEANS}, {_STDS}, {_DIFFS}, {_LAGS}, {_INTERACTIONS}, {_TIME}
        FROM b_sensor_readings)""")
def feature_build(t: Tables) -> DataFrame:
    built = series.build_features(t.readings)
    return built.select(
        "series_id", "reading_id", "hour", "day_of_week",
        *(F.round(F.col(n), 6).alias(n) for n in (*_NUMERIC, "hour_sin", "hour_cos")))


@query("ts_outlier_filter", """
  SELECT count(*) FILTER (WHERE sound_level >= 1.0) AS kept,
    count(*) FILTER (WHERE sound_level < 1.0 OR sound_level IS NULL) AS removed
  FROM b_sensor_readings""")
def outlier_filter(t: Tables) -> DataFrame:
    return series.outlier_counts(t.readings, "sound_level", 1.0)


@query("ml_time_split", f"""
  SELECT reading_id, CASE WHEN reading_ts < timestamp '{BOUNDARY}' THEN 'train' ELSE 'test' END
    AS part FROM b_sensor_readings""")
def time_split(t: Tables) -> DataFrame:
    train, test = series.time_split(t.readings.select("reading_id", "reading_ts"),
                                    "reading_ts", BOUNDARY)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))).drop("reading_ts")


@query("ts_decision_rule", """
  SELECT series_id, reading_id, CASE WHEN fineness > 8.0 THEN 'increase separator speed'
    WHEN fineness < 6.5 THEN 'decrease separator fan' ELSE 'hold' END AS advice
  FROM b_sensor_readings""")
def decision_rule(t: Tables) -> DataFrame:
    return advise(t.readings, LABEL).select("series_id", "reading_id", "advice")


# --- regression ----------------------------------------------------------------------------


def _prepared(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Scaled train and test rows, stored; the scaler is fitted on cleaned training rows only.

    Features are computed once, over the whole series, then split by time: they look back only.
    """
    features = cut_lineage(series.build_features(t.readings).select(
        "series_id", "reading_id", "reading_ts", LABEL, *series.feature_names()))
    train, test = series.time_split(features, "reading_ts", BOUNDARY)
    train = series.outlier_filter(train, "sound_level", 0.1)
    fitted = models.scaler(series.feature_names()).fit(train)
    keep = ["series_id", "reading_id", LABEL, "features"]
    return tuple(cut_lineage(fitted.transform(df).select(*keep)) for df in (train, test))


def _fitted(train: DataFrame, *builds):
    """Models fitted on the same rows, which are kept only while the fits iterate over them."""
    kept = models.gathered(train).persist()
    fits = [build(kept).fit(kept) for build in builds]
    kept.unpersist()
    return fits


def _forest(_: DataFrame):
    return models.random_forest(LABEL)


def _boosted(_: DataFrame):
    return models.boosted_trees(LABEL)


@query("ml_standard_scale", f"""
  SELECT feature, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS deviation FROM (
    UNPIVOT (SELECT {', '.join(series.SENSORS)} FROM (
      SELECT sound_level, production_rate, sepol_drive_speed, separator_fan, mill_feed_rate,
        bucket_elev, main_motor, coalesce({_LAST_KNOWN.format(s='gypsum_feed')}, 0) AS gypsum_feed,
        reading_ts FROM b_sensor_readings)
      WHERE reading_ts < timestamp '{BOUNDARY}' AND sound_level >= 0.1)
    ON {', '.join(series.SENSORS)} INTO NAME feature VALUE v)
  GROUP BY feature""")
def standard_scale(t: Tables) -> DataFrame:
    filled = series.Series.of(t.readings, KEYS, ORDER).fill(
        series.SENSORS, forward_only=True).result()
    train, _ = series.time_split(filled, "reading_ts", BOUNDARY)
    train = series.outlier_filter(train, "sound_level", 0.1)
    fitted = models.scaler(series.SENSORS).fit(train)
    return models.scaling_table(fitted, t.spark, series.SENSORS).select(
        "feature", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@query("ml_linear_models")
def linear_models(t: Tables) -> DataFrame:
    train, test = _prepared(t)
    ridge, lasso, elastic_net = _fitted(
        train, lambda d: models.ridge(d, LABEL), lambda d: models.lasso(d, LABEL),
        lambda d: models.elastic_net(d, LABEL))
    return models.metrics_by_model({
        "ridge": ridge.transform(test), "lasso": lasso.transform(test),
        "elastic_net": elastic_net.transform(test)}, LABEL)


@query("ml_random_forest")
def random_forest(t: Tables) -> DataFrame:
    train, test = _prepared(t)
    (forest,) = _fitted(train, _forest)
    return models.regression_metrics(forest.transform(test), LABEL)


@query("ml_gbt")
def boosted_trees(t: Tables) -> DataFrame:
    train, test = _prepared(t)
    (boosted,) = _fitted(train, _boosted)
    return models.regression_metrics(boosted.transform(test), LABEL)


@query("ml_stacking")
def stacking(t: Tables) -> DataFrame:
    train, test = _prepared(t)
    return models.regression_metrics(models.stack(
        train, test, LABEL, ["series_id", "reading_id"],
        {"ridge": models.ridge(train, LABEL), "boosted": _boosted(train)}, folds=5), LABEL)


# One feature, whose weights have closed forms; the penalties are strong enough to be seen.
_PENALTIES = {"ridge": 5000.0, "lasso": 0.5, "elastic_net": 0.5}


@query("ml_linear_univariate", f"""
  WITH train AS (SELECT mill_feed_rate AS x, fineness AS y FROM b_sensor_readings
    WHERE reading_ts < timestamp '{BOUNDARY}' AND sound_level >= 0.1),
  sums AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS sxx, covar_pop(x, y) AS sxy FROM train),
  weights AS (
    SELECT 'ridge' AS model, sxy / (sxx + {_PENALTIES['ridge']} / n) AS w, mx, my FROM sums
    UNION ALL SELECT 'lasso', sign(sxy) * greatest(abs(sxy) - {_PENALTIES['lasso']}, 0) / sxx, mx, my FROM sums
    UNION ALL SELECT 'elastic_net', sign(sxy) * greatest(abs(sxy) - {_PENALTIES['elastic_net'] / 2}, 0)
      / (sxx + {_PENALTIES['elastic_net'] / 2}), mx, my FROM sums)
  SELECT model, round(w, 4) AS weight, round(my - w * mx, 4) AS intercept, round(mae, 4) AS mae
  FROM weights w JOIN (
    SELECT model, avg(abs(fineness - (my + w * (mill_feed_rate - mx)))) AS mae
    FROM b_sensor_readings, weights WHERE reading_ts >= timestamp '{BOUNDARY}' GROUP BY model) e USING (model)""")
def linear_univariate(t: Tables) -> DataFrame:
    train, test = series.time_split(t.readings, "reading_ts", BOUNDARY)
    vector = VectorAssembler(inputCols=["mill_feed_rate"], outputCol="features")
    train, test = (cut_lineage(vector.transform(df).select(LABEL, "features")) for df in (
        series.outlier_filter(train, "sound_level", 0.1), test))
    builds = {"ridge": models.ridge, "lasso": models.lasso, "elastic_net": models.elastic_net}
    fits = {n: build(train, LABEL, _PENALTIES[n]).fit(train) for n, build in builds.items()}
    measured = models.metrics_by_model({n: fit.transform(test) for n, fit in fits.items()}, LABEL)
    weights = t.spark.createDataFrame(
        [(n, float(fit.coefficients[0]), float(fit.intercept)) for n, fit in fits.items()],
        "model string, weight double, intercept double")
    return weights.join(measured.select("model", "mae"), "model").select(
        "model", *(F.round(c, 4).alias(c) for c in ("weight", "intercept", "mae")))


@query("ml_leaderboard_models")
def leaderboard_models(t: Tables) -> DataFrame:
    """The fitted models by accuracy: linear ones, forest, boosting, and the stack of two of them."""
    train, test = _prepared(t)
    root, ids = new_folder(t.spark, "models"), ["series_id", "reading_id"]
    stacked = models.stack(train, test, LABEL, ids, {
        "ridge": models.ridge(train, LABEL), "boosted": _boosted(train)}, store=f"{root}/stack")
    others = models.scored_side_by_side(train, test, ids, {
        "lasso": models.lasso(train, LABEL), "elastic_net": models.elastic_net(train, LABEL),
        "random_forest": _forest(train)}, f"{root}/others")
    scored = stacked.withColumnRenamed("prediction", "stacked").join(others, ids)
    names = ["ridge", "lasso", "elastic_net", "random_forest", "boosted", "stacked"]
    return models.leaderboard(models.metrics_by_model(
        {n: scored.select(LABEL, F.col(n).alias("prediction")) for n in names}, LABEL))


# Persistence forecast: the previous reading's label predicts the next one.
_FORECAST = "SELECT fineness, " + _over("lag(fineness)") + " AS prediction FROM b_sensor_readings"


def _metrics_sql(source: str) -> str:
    return f"""
  SELECT count(*) AS n,
    round(1 - sum(power(fineness - prediction, 2)) / (var_samp(fineness) * (count(*) - 1)), 6) AS r2,
    round(avg(abs(fineness - prediction)), 6) AS mae,
    round(sqrt(avg(power(fineness - prediction, 2))), 6) AS rmse,
    round(avg(abs((fineness - prediction) / fineness)) * 100, 6) AS mape,
    round(100 - avg(abs((fineness - prediction) / fineness)) * 100, 6) AS accuracy
  FROM ({source}) WHERE prediction IS NOT NULL"""


def _forecast(t: Tables) -> DataFrame:
    return series.Series.of(t.readings, KEYS, ORDER).with_windows(
        1, lambda w: {"prediction": F.lag(LABEL, 1).over(w)}).result().filter(
        "prediction IS NOT NULL")


def _constant(t: Tables) -> DataFrame:
    return t.readings.withColumn("prediction", F.lit(8.0))


@query("ml_regression_metrics", _metrics_sql(_FORECAST))
def regression_metrics(t: Tables) -> DataFrame:
    measured = models.regression_metrics(_forecast(t), LABEL)
    return measured.select("n", *(
        F.round(c, 6).alias(c) for c in ("r2", "mae", "rmse", "mape", "accuracy")))


@query("ml_leaderboard", f"""
  SELECT row_number() OVER (ORDER BY accuracy DESC, model) AS place, model, accuracy,
    round(accuracy - {models.BASELINE_ACCURACY}, 6) AS gain,
    accuracy > {models.BASELINE_ACCURACY} AS beats_baseline
  FROM (SELECT 'persistence' AS model, accuracy FROM ({_metrics_sql(_FORECAST)}) p
    UNION ALL SELECT 'constant', accuracy FROM ({_metrics_sql(
        'SELECT fineness, 8e0 AS prediction FROM b_sensor_readings')}) c)""")
def leaderboard(t: Tables) -> DataFrame:
    metrics = models.metrics_by_model(
        {"persistence": _forecast(t), "constant": _constant(t)}, LABEL)
    return models.leaderboard(metrics).withColumns({
        "accuracy": F.round("accuracy", 6), "gain": F.round("gain", 6)})


@query("ml_feature_importance")
def feature_importance(t: Tables) -> DataFrame:
    train, _ = _prepared(t)
    (boosted,) = _fitted(train, _boosted)
    return models.feature_importance(boosted, t.spark, series.feature_names())
