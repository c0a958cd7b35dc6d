"""Column-level helpers (F1-F12). All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def window_bounds(window_col: str = "window") -> list[Column]:
    """``window.start`` / ``window.end`` as flat columns."""
    return [F.col(f"{window_col}.start").alias("window_start"), F.col(f"{window_col}.end").alias("window_end")]


def window_starts_containing(bucket_start_us: Column, slide_us: int, n_windows: int) -> Column:
    """Array of the ``n_windows`` sliding-window starts (epoch micros) that
    contain a slide-aligned bucket starting at ``bucket_start_us``."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_windows - 1)),
                       lambda k: bucket_start_us - k.cast("long") * F.lit(slide_us))


def epoch_ms(ts: Column) -> Column:
    """TIMESTAMP -> epoch milliseconds."""
    return F.unix_millis(ts)


def from_epoch_ms(ms: Column) -> Column:
    """epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(ms)


def guarded_ratio(n: Column, avg: Column) -> Column:
    """``n / avg``, 0.0 when the average is 0 (or absent)."""
    return F.when(F.coalesce(avg, F.lit(0.0)) == 0.0, F.lit(0.0)).otherwise(n.cast("double") / avg)


def spike_flag(n: Column, avg: Column, has_history: Column, multiplier: float) -> Column:
    """history must exist and the count must be strictly above ``avg * k``."""
    return has_history & (n.cast("double") > F.coalesce(avg, F.lit(0.0)) * F.lit(float(multiplier)))


def push_history(history: Column, value: Column, keep: int) -> Column:
    """F8: append ``value`` and keep the last ``keep`` elements."""
    appended = F.concat(F.coalesce(history, F.array().cast(T.ArrayType(T.LongType()))),
                        F.array(value.cast("long")))
    return F.when(F.size(appended) > keep, F.slice(appended, -keep, keep)).otherwise(appended)


def history_mean(history: Column) -> Column:
    """mean of an array of counts, 0.0 when empty."""
    total = F.aggregate(history, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return F.when(F.size(history) > 0, total.cast("double") / F.size(history)).otherwise(F.lit(0.0))


def is_blank(c: Column) -> Column:
    """null or only whitespace."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def round2(c: Column) -> Column:
    """F4 ``ROUND(x, 2)`` on the decimal text of the double (HALF_UP), returned as double.

    Rounding through a decimal cast keeps Spark and SQL engines that round the
    binary value from disagreeing on ties such as 2.675.
    """
    return F.round(c.cast("decimal(38,12)"), 2).cast("double")


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (UTC wall clock) for
    comparison with engines whose timestamps carry no zone."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
