"""Column expressions shared by the operators.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintagecast import config

#: Measures are summed to nine decimals, up to 29 digits before the point.
_DEC = "decimal(38,9)"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- exact means
# Floating sums depend on the order rows meet; at scale that order changes
# between runs.  Summing DECIMAL(38,9) is exact, so the mean is the same on
# every run and on every partitioning.

def exact_sum(c: Column | str) -> Column:
    """Order-independent sum of a measure (NULL when all inputs are NULL)."""
    return F.sum(col_(c).cast(_DEC)).cast("double")


def exact_mean(c: Column | str) -> Column:
    """Order-independent mean: exact decimal sum / non-NULL count."""
    c = col_(c)
    return F.sum(c.cast(_DEC)).cast("double") / F.nullif(F.count(c), F.lit(0))


def exact_mean_rounded(c: Column | str, digits: int) -> Column:
    """Mean rounded half away from zero on the exact decimal value."""
    c = col_(c)
    return F.round(F.sum(c.cast(_DEC)) / F.nullif(F.count(c), F.lit(0)), digits).cast("double")


def rate(pred: Column) -> Column:
    """Share of rows where ``pred`` holds (the ``AVG(CASE .. 1 ELSE 0)`` idiom)."""
    return F.sum(F.when(pred, 1).otherwise(0)).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))


def ordered_string_agg(value: Column | str, order: Column | str, sep: str) -> Column:
    """``string_agg(value, sep ORDER BY order)``: NULL values skipped, NULL when
    nothing is left.  Meant for small bounded groups (day parts, hours of a day)."""
    value, order = col_(value), col_(order)
    items = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    joined = F.array_join(F.transform(items, lambda x: x["v"]), sep)
    return F.when(F.count(value) > 0, joined)


# ---------------------------------------------------------------- labels

def daypart_label(hour: Column | str, part_set: str = "C") -> Column:
    """Hour of day -> day part name; first matching band wins."""
    hour = col_(hour)
    expr = None
    for name, lo, hi in config.DAYPART_SETS[part_set]:
        cond = hour.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    other = config.DAYPART_ELSE[part_set]
    return expr.otherwise(F.lit(other).cast("string"))


def daypart_order(label: Column | str) -> Column:
    label = col_(label)
    expr = None
    for i, name in enumerate(config.DAYPART_ORDER, start=1):
        expr = F.when(label == name, F.lit(i)) if expr is None else expr.when(label == name, F.lit(i))
    return expr.otherwise(F.lit(config.DAYPART_ORDER_ELSE))


def sky_text(mean_cloud: Column | str) -> Column:
    mean_cloud = col_(mean_cloud)
    expr = F.when(mean_cloud.isNull(), F.lit(config.SKY_UNKNOWN))
    for bound, name in config.SKY_BANDS:
        expr = expr.when(mean_cloud <= bound, F.lit(name))
    return expr.otherwise(F.lit(config.SKY_ELSE))


# ---------------------------------------------------------------- time

def to_local(ts_utc: Column | str, zone: Column) -> Column:
    """UTC instant (NTZ) -> local wall clock (NTZ) in ``zone`` (a zone-name column;
    per-row zones are allowed, so each location keeps its own)."""
    return F.convert_timezone(F.lit("UTC"), zone, col_(ts_utc))


def hour_floor(ts: Column | str) -> Column:
    """Truncate an NTZ timestamp to the hour, staying NTZ."""
    return F.date_trunc("hour", col_(ts)).cast("timestamp_ntz")


def day_floor(ts: Column | str) -> Column:
    return F.date_trunc("day", col_(ts)).cast("timestamp_ntz")


def plus_hours(ts: Column | str, hours: int | Column) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return col_(ts) + F.make_dt_interval(F.lit(0), h.cast("int"))


def hour_of(ts: Column | str) -> Column:
    return F.hour(col_(ts)).cast("bigint")


def in_window(ts: Column | str, start: Column, hours: int) -> Column:
    """Half-open window [start, start + hours)."""
    ts = col_(ts)
    return (ts >= start) & (ts < plus_hours(start, hours))


# ---------------------------------------------------------------- gating

def in_cooldown(now: Column | str, last_sent: Column | str, hours: int) -> Column:
    """Never sent -> FALSE; now < last + hours -> TRUE (strict); else FALSE."""
    now, last_sent = col_(now), col_(last_sent)
    return (F.when(last_sent.isNull(), F.lit(False))
            .when(now < plus_hours(last_sent, hours), F.lit(True))
            .otherwise(F.lit(False)))


# ---------------------------------------------------------------- text

def py_str_double(c: Column | str) -> Column:
    """Text of a double as Python's ``str(float)`` shows it for ordinary values."""
    return col_(c).cast("string")


def int_text_half_even(c: Column | str) -> Column:
    """``f"{x:.0f}"`` of a double: round half to even, no decimals."""
    return F.bround(col_(c), 0).cast("bigint").cast("string")


def rain_alert_message() -> Column:
    return F.lit(config.RAIN_MESSAGE)


def wind_alert_message(max_wind: Column | str) -> Column:
    max_wind = col_(max_wind)
    return F.when(max_wind.isNull(), F.lit(config.WIND_MESSAGE_PLAIN)).otherwise(
        F.format_string(config.WIND_MESSAGE_FMT, int_text_half_even(max_wind)))


def brief_message(location: Column | str, temp: Column | str, feels: Column | str,
                  sky: Column | str, rain: Column | str, max_wind: Column | str,
                  dayparts_line: Column | str, wind_line_kmh: float) -> Column:
    """Digest text: one line each; optional lines left out (``concat_ws`` skips NULL)."""
    location, temp, feels = col_(location), col_(temp), col_(feels)
    sky, rain, max_wind, parts = col_(sky), col_(rain), col_(max_wind), col_(dayparts_line)
    head = F.concat(F.lit("Morning brief ("), location, F.lit("): "))
    first = (F.when(temp.isNotNull() & feels.isNotNull(),
                    F.concat(head, py_str_double(temp), F.lit(config.DEGREE_C + " (feels like "),
                             py_str_double(feels), F.lit(config.DEGREE_C + ")")))
             .when(temp.isNotNull(), F.concat(head, py_str_double(temp), F.lit(config.DEGREE_C)))
             .otherwise(F.concat(head, F.lit("(temperature unavailable)"))))
    sky_t = F.coalesce(F.nullif(F.trim(sky), F.lit("")), F.lit(config.SKY_UNKNOWN))
    sky_line = F.concat(F.lit("Sky: "), sky_t)
    rain_line = F.when(F.coalesce(rain.cast("boolean"), F.lit(False)), F.lit("Rain: possible"))
    wind_line = F.when(max_wind >= wind_line_kmh,
                       F.concat(F.lit("Wind: up to "), int_text_half_even(max_wind), F.lit(" km/h")))
    parts_t = F.trim(parts)
    parts_line = F.when(parts_t.isNotNull() & (F.length(parts_t) > 0),
                        F.concat(F.lit("Dayparts: "), parts_t))
    return F.concat_ws("\n", first, sky_line, rain_line, wind_line, parts_line)
