"""Time features (P5-P12): date, timestamp, year, availability, hour, cyclic hour,
day of week and weekend flag, all in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.functions.exprs import cyclic, parse_date, parse_timestamp


def make_time_features(df: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Adds ``stop_ts, year, time_available, hour_of_day, hour_sin, hour_cos, day_of_week,
    is_weekend`` and turns the date text into a DATE.

    Parity: ``time_available`` means "raw time is not NULL", so a time of ``NA`` counts
    as available with a NULL hour and ``is_weekend`` 0.  Strict: it means "the timestamp
    parsed".  The day of week runs 1 = Sunday .. 7 = Saturday.
    """
    d, t = cfg.date_column, cfg.time_column
    date = parse_date(d)
    stamp = parse_timestamp(F.concat_ws(" ", date.cast("string"), F.col(t)), cfg.timestamp_format)
    df = df.withColumns({d: date, "stop_ts": stamp})
    avail = (F.col("stop_ts") if cfg.strict else F.col(t)).isNotNull().cast("int")
    df = df.withColumns({"year": F.year(d), "time_available": avail})
    on = F.col("time_available") == 1
    df = df.withColumns({"hour_of_day": F.when(on, F.hour("stop_ts")),
                         "day_of_week": F.when(on, F.dayofweek("stop_ts"))})
    return df.withColumns({
        "hour_sin": F.when(on, cyclic("hour_of_day", 24.0, "sin")),
        "hour_cos": F.when(on, cyclic("hour_of_day", 24.0, "cos")),
        "is_weekend": F.when(on & F.col("day_of_week").isin(1, 7), F.lit(1)).when(on, F.lit(0)),
    })
