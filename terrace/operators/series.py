"""Row-ordered computations per series, safe for a series that holds most of the rows.

A window over a series would put the series into one task. Rows are range-partitioned by
(series, order) instead, so chunks are balanced whatever the skew, and every chunk is given the
few rows that precede it in its series. Adaptive execution sizes the chunks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from terrace.session import cut_lineage

CHUNK, HALO = "_chunk", "_halo"


@dataclass(frozen=True)
class Series:
    """Rows of `df` per `series`, ordered by `order` (unique within a series)."""

    df: DataFrame
    series: tuple[str, ...]
    order: tuple[str, ...]

    @classmethod
    def of(
        cls, df: DataFrame, series: Sequence[str], order: Sequence[str],
        chunks: int | None = None,
    ) -> Series:
        by = [*series, *order]
        ranged = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
        # The chunk number must not change when a task is rerun, hence the stored copy.
        numbered = cut_lineage(ranged.withColumn(CHUNK, F.spark_partition_id()))
        return cls(numbered, tuple(series), tuple(order))

    def result(self) -> DataFrame:
        return self.df.drop(CHUNK)

    def with_columns(self, columns: Mapping[str, Column]) -> Series:
        return replace(self, df=self.df.withColumns(columns))

    def _window(self, descending: bool = False) -> WindowSpec:
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.series, CHUNK).orderBy(*order)

    def _with_preceding(self, back: int) -> DataFrame:
        """Rows plus, per chunk, copies of the `back` rows before its first one."""
        last = F.row_number().over(self._window(descending=True))
        tails = self.df.withColumn("_last", last).filter(F.col("_last") <= back).drop("_last")
        # At most `back` rows per chunk remain, so this window is small for any series.
        w = Window.partitionBy(*self.series).orderBy(*self.order)
        following = F.array(*(F.lead(CHUNK, i).over(w) for i in range(1, back + 1)))
        halo = (
            tails.withColumn("_following", following)
            .withColumn(CHUNK, F.explode(F.array_distinct(F.filter(
                F.col("_following"), lambda c: c > F.col(CHUNK)))))
            .drop("_following").withColumn(HALO, F.lit(True)))
        return self.df.withColumn(HALO, F.lit(False)).unionByName(halo)

    def with_windows(
        self, back: int, build: Callable[[WindowSpec], Mapping[str, Column]]
    ) -> Series:
        """Add the columns `build(window)` returns; they may look `back` rows back at most."""
        rows = self._with_preceding(back).withColumns(build(self._window()))
        return replace(self, df=rows.filter(~F.col(HALO)).drop(HALO))

    def fill(self, columns: Sequence[str], forward_only: bool = False) -> Series:
        """Next known value, else last known value, else 0 (or last known, else 0)."""
        ahead, behind = self._window(descending=True), self._window()
        rows = self.df.join(self._known_around(columns, forward_only), [*self.series, CHUNK], "left")
        filled = {}
        for c in columns:
            sources = [F.col(c)]
            if not forward_only:
                sources.append(F.last(c, ignorenulls=True).over(ahead))
                sources.append(F.col(f"_after_{c}"))
            sources.append(F.last(c, ignorenulls=True).over(behind))
            sources.append(F.col(f"_before_{c}"))
            sources.append(F.lit(0).cast(self.df.schema[c].dataType))
            filled[c] = F.coalesce(*sources)
        return replace(self, df=rows.select(
            *(filled[c].alias(c) if c in filled else F.col(c) for c in self.df.columns)))

    def _known_around(self, columns: Sequence[str], forward_only: bool) -> DataFrame:
        """Per series and chunk: last known value in earlier chunks, and first in later ones if asked for."""
        known_at = lambda c: F.when(F.col(c).isNotNull(), F.struct(*self.order))
        last = [F.max_by(c, known_at(c)).alias(f"_last_{c}") for c in columns]
        first = [] if forward_only else [F.min_by(c, known_at(c)).alias(f"_first_{c}") for c in columns]
        known = self.df.groupBy(*self.series, CHUNK).agg(*last, *first)
        # One row per chunk: the windows below are bounded by the number of chunks.
        up, down = (Window.partitionBy(*self.series).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
                    for order in (F.col(CHUNK).asc(), F.col(CHUNK).desc()))
        before = [F.last(f"_last_{c}", ignorenulls=True).over(up).alias(f"_before_{c}") for c in columns]
        after = [] if forward_only else [
            F.last(f"_first_{c}", ignorenulls=True).over(down).alias(f"_after_{c}") for c in columns]
        return known.select(*self.series, CHUNK, *before, *after)


# --- window columns ------------------------------------------------------------------------


def rolling_mean(names: Sequence[str], rows: int, w: WindowSpec, suffix: str) -> Mapping[str, Column]:
    return {f"{n}_{suffix}": F.avg(n).over(w.rowsBetween(1 - rows, 0)) for n in names}


def rolling_std(names: Sequence[str], rows: int, w: WindowSpec, suffix: str) -> Mapping[str, Column]:
    """Sample deviation; 0 where fewer than two values are known."""
    frame = w.rowsBetween(1 - rows, 0)
    return {f"{n}_{suffix}": F.coalesce(F.stddev_samp(n).over(frame), F.lit(0.0)) for n in names}


def difference(names: Sequence[str], w: WindowSpec) -> Mapping[str, Column]:
    return {f"{n}_diff": F.coalesce(F.col(n) - F.lag(n, 1).over(w), F.lit(0.0)) for n in names}


def lags(names: Sequence[str], steps: Sequence[int], w: WindowSpec) -> Mapping[str, Column]:
    return {f"{n}_lag{k}": F.lag(n, k).over(w) for n in names for k in steps}


# --- sensor features -----------------------------------------------------------------------

# The eight readings of a mill and the products and quotients taken of them.
SENSORS = [
    "sound_level", "production_rate", "gypsum_feed", "sepol_drive_speed", "separator_fan",
    "mill_feed_rate", "bucket_elev", "main_motor",
]
PRODUCTS = {
    "mill_feed_x_separator_fan": ("mill_feed_rate", "separator_fan"),
    "main_motor_x_sound": ("main_motor", "sound_level"),
    "mill_feed_x_bucket_elev": ("mill_feed_rate", "bucket_elev"),
    "production_x_gypsum_feed": ("production_rate", "gypsum_feed"),
    "sepol_speed_x_separator_fan": ("sepol_drive_speed", "separator_fan"),
}
QUOTIENTS = {
    "main_motor_per_mill_feed": ("main_motor", "mill_feed_rate"),
    "sound_per_mill_feed": ("sound_level", "mill_feed_rate"),
    "bucket_elev_per_mill_feed": ("bucket_elev", "mill_feed_rate"),
    "production_per_main_motor": ("production_rate", "main_motor"),
}
TIME_FEATURES = ["hour", "day_of_week", "hour_sin", "hour_cos"]


def interactions() -> Mapping[str, Column]:
    """Products, and quotients that are null where the divisor is zero."""
    return {
        **{name: F.col(a) * F.col(b) for name, (a, b) in PRODUCTS.items()},
        **{name: F.try_divide(F.col(a), F.col(b)) for name, (a, b) in QUOTIENTS.items()},
    }


def cyclic_time(ts: str) -> Mapping[str, Column]:
    angle = F.lit(2 * math.pi) * F.hour(ts) / F.lit(24)
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(F.col(ts).cast("date")),
        "hour_sin": F.sin(angle),
        "hour_cos": F.cos(angle),
    }


def feature_names() -> list[str]:
    return [
        *SENSORS,
        *(f"{s}_{x}" for s in SENSORS for x in ("roll4_mean", "roll8_mean", "roll4_std")),
        *(f"{s}_diff" for s in SENSORS),
        *(f"{s}_lag{k}" for s in SENSORS for k in (1, 2)),
        *PRODUCTS, *QUOTIENTS, *TIME_FEATURES,
    ]


def _windowed(w: WindowSpec) -> Mapping[str, Column]:
    # The names keep the sensor interval they were given (4 and 8 hours of 2-hour readings).
    return {
        **rolling_mean(SENSORS, 2, w, "roll4_mean"),
        **rolling_mean(SENSORS, 4, w, "roll8_mean"),
        **rolling_std(SENSORS, 2, w, "roll4_std"),
        **difference(SENSORS, w),
        **lags(SENSORS, (1, 2), w),
    }


def build_features(
    readings: DataFrame,
    series: Sequence[str] = ("series_id",),
    order: Sequence[str] = ("reading_ts", "reading_id"),
    chunks: int | None = None,
    back_fill: bool = False,
) -> DataFrame:
    """69 features per reading: one sort per series serves all windows.

    Unknown values take the last known one, else 0. `back_fill` looks ahead first, which
    leaks later readings into a training row, so it is off unless asked for.
    """
    numeric = [n for n in feature_names() if n not in TIME_FEATURES]
    return (
        Series.of(readings, series, order, chunks)
        .with_windows(3, _windowed)
        .with_columns({**interactions(), **cyclic_time(order[0])})
        .fill(numeric, forward_only=not back_fill)
        .result())


def outlier_filter(readings: DataFrame, column: str, low: float) -> DataFrame:
    return readings.filter(F.col(column) >= low)


def outlier_counts(readings: DataFrame, column: str, low: float) -> DataFrame:
    keep = F.col(column) >= low
    return readings.agg(
        F.count_if(keep).alias("kept"), F.count_if(~keep | keep.isNull()).alias("removed"))


def time_split(df: DataFrame, ts: str, boundary: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): readings before the boundary and from it on."""
    edge = F.lit(boundary).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) < edge), df.filter(F.col(ts) >= edge)


def decision(prediction: str, half_width: str | None = None, max_half_width: float = 1.0) -> Column:
    """Operator advice for a predicted fineness; a wide interval asks for a review."""
    value = F.col(prediction)
    advice = (
        F.when(value > 8.0, "increase separator speed")
        .when(value < 6.5, "decrease separator fan")
        .otherwise("hold"))
    if half_width is None:
        return advice
    return F.when(F.col(half_width) > max_half_width, "operator review").otherwise(advice)
