"""Daily digest ("morning brief") per (location, run).

Each run's current snapshot comes from the as-of step; hourly rows are
reached by an equi join on (location, snapshot) with the window as a
residual filter.  Aggregations are keyed by (location, run[, part]).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagecast import config
from vintagecast.config import RULES, Rules
from vintagecast.functions.columns import (
    brief_message, day_floor, daypart_label, daypart_order, exact_mean, exact_mean_rounded,
    hour_floor, ordered_string_agg, plus_hours, sky_text, to_local)
from vintagecast.operators.alerts import horizon_rows, rows_in_windows
from vintagecast.operators.versions import KEY, PART, SNAP, current_versions, history_rows, snapshot_list

_MEAS = ["forecast_time_local", "forecast_date_local", "forecast_hour_local", "temperature_c",
         "feels_like_c", "precipitation_mm", "wind_kmh", "cloudcover_pct"]


def _current(hourly: DataFrame, runs: DataFrame, snaps: DataFrame | None = None) -> DataFrame:
    """Each run's current snapshot.  ``snaps`` is the version list (the
    registry: small metadata); without it the list is a distinct over
    ``hourly``, which at scale means a scan of the snapshot columns."""
    return current_versions(snaps if snaps is not None else snapshot_list(hourly), runs)


def brief_v1(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
             snaps: DataFrame | None = None) -> DataFrame:
    """Exact 12h horizon from now: means to 1 decimal, rain 0/1, max wind to 0
    decimals.  One row per run, NULL measures when the window is empty."""
    rows = horizon_rows(hourly, _current(hourly, runs, snaps), rules.digest_horizon_hours, columns=_MEAS)
    rows = rows.select(KEY, "as_of_utc", F.lit(1).alias("_real"), "temperature_c", "feels_like_c",
                       "precipitation_mm", "wind_kmh")
    spine = runs.select(KEY, "as_of_utc", F.lit(None).cast("int").alias("_real"),
                        *[F.lit(None).cast("double").alias(c) for c in
                          ("temperature_c", "feels_like_c", "precipitation_mm", "wind_kmh")])
    g = rows.unionByName(spine).groupBy(KEY, "as_of_utc").agg(
        exact_mean_rounded("temperature_c", 1).alias("avg_temp_next12h"),
        exact_mean_rounded("feels_like_c", 1).alias("avg_feels_next12h"),
        F.max(F.when(F.col("_real") == 1, F.when(F.col("precipitation_mm") > 0, 1).otherwise(0))).alias("_rain"),
        F.round(F.max("wind_kmh"), 0).alias("max_wind_next12h"))
    tz = runs.select(KEY, "as_of_utc", "timezone")
    return g.join(tz, [KEY, "as_of_utc"]).select(
        KEY, F.col("as_of_utc").alias("run_time_utc"),
        F.to_date(to_local("as_of_utc", F.col("timezone"))).alias("today_local_date"),
        "avg_temp_next12h", "avg_feels_next12h", F.col("_rain").alias("any_rain_next12h"), "max_wind_next12h")


def _v2_window(hourly: DataFrame, runs: DataFrame, rules: Rules, snaps: DataFrame | None = None,
               current: DataFrame | None = None) -> DataFrame:
    v = current if current is not None else _current(hourly, runs, snaps)
    return horizon_rows(hourly, v, rules.digest_horizon_hours, align_hour=True, columns=_MEAS)


def _v2_agg(rows: DataFrame) -> DataFrame:
    g = rows.groupBy(KEY, "as_of_utc", SNAP).agg(
        exact_mean("temperature_c").alias("_t"), exact_mean("feels_like_c").alias("_f"),
        exact_mean("cloudcover_pct").alias("_c"),
        exact_mean_rounded("temperature_c", 1).alias("avg_temp_c_12h"),
        exact_mean_rounded("feels_like_c", 1).alias("avg_feels_like_c_12h"),
        exact_mean_rounded("cloudcover_pct", 0).alias("avg_cloudcover_pct_12h"),
        (F.max(F.coalesce("precipitation_mm", F.lit(0.0))) > 0).alias("rain_possible"),
        F.round(F.max("wind_kmh"), 0).alias("max_wind_kmh_12h"),
        F.min("forecast_time_local").alias("window_start_local"),
        F.max("forecast_time_local").alias("window_end_local"),
        F.count(F.lit(1)).alias("n_hours"))
    return g.withColumn("sky_text", sky_text(F.col("_c")))


V2_COLUMNS = [KEY, "run_time_utc", SNAP, "avg_temp_c_12h", "avg_feels_like_c_12h", "avg_cloudcover_pct_12h",
              "sky_text", "rain_possible", "max_wind_kmh_12h", "window_start_local", "window_end_local",
              "n_hours"]


def brief_v2(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
             snaps: DataFrame | None = None) -> DataFrame:
    """Hour-aligned 12h window: means, sky, rain flag, max wind, window bounds."""
    g = _v2_agg(_v2_window(hourly, runs, rules, snaps=snaps))
    return g.withColumnRenamed("as_of_utc", "run_time_utc").select(*V2_COLUMNS)


def _part_agg(rows: DataFrame, part_set: str) -> DataFrame:
    lab = rows.withColumn("daypart", daypart_label(F.col("forecast_hour_local"), part_set))
    return (lab.where(F.col("daypart").isNotNull())
            .groupBy(KEY, "as_of_utc", SNAP, "daypart")
            .agg(exact_mean_rounded("temperature_c", 0).alias("_temp0"),
                 (F.max(F.coalesce("precipitation_mm", F.lit(0.0))) > 0).alias("rain_possible"))
            .withColumn("sort_key", daypart_order(F.col("daypart"))))


def _part_text(tag: F.Column) -> F.Column:
    return F.concat(F.col("daypart"), F.lit(" "), F.col("_temp0").cast("int").cast("string"),
                    F.lit(config.DEGREE_C), tag)


def dayparts_line(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES, part_set: str = "C",
                  snaps: DataFrame | None = None) -> DataFrame:
    """Next 12 hours by day part: '<part> <temp>°C[ (rain)]' joined in day order."""
    parts = _part_agg(_v2_window(hourly, runs, rules, snaps=snaps), part_set)
    txt = _part_text(F.when(F.col("rain_possible"), F.lit(config.RAIN_TAG)).otherwise(F.lit("")))
    return parts.groupBy(KEY, "as_of_utc", SNAP).agg(
        ordered_string_agg(txt, F.col("sort_key"), config.DAYPART_SEPARATOR).alias("dayparts_line")
    ).withColumnRenamed("as_of_utc", "run_time_utc")


def _today_band(hourly: DataFrame, runs: DataFrame, rules: Rules, snaps: DataFrame | None = None,
                current: DataFrame | None = None) -> DataFrame:
    v = current if current is not None else _current(hourly, runs, snaps)
    v = v.withColumn("_day", day_floor(to_local("as_of_utc", F.col("timezone"))))
    return rows_in_windows(hourly, v, plus_hours("_day", rules.day_band_start_hour),
                           plus_hours("_day", rules.day_band_end_hour), _MEAS).drop("_day")


def dayparts_meta(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES, part_set: str = "C",
                  snaps: DataFrame | None = None) -> DataFrame:
    parts = _part_agg(_today_band(hourly, runs, rules, snaps=snaps), part_set)
    return parts.groupBy(KEY, "as_of_utc", SNAP).agg(
        F.sum(F.when(F.col("rain_possible"), 1).otherwise(0)).cast("bigint").alias("rainy_parts"),
        F.count(F.lit(1)).alias("total_parts")).withColumnRenamed("as_of_utc", "run_time_utc")


def brief_final(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES, part_set: str = "C",
                snaps: DataFrame | None = None) -> DataFrame:
    """brief_v2 + a day-parts line over today's 06-24 band; rain tags left out
    when every part is rainy."""
    # one as-of step and one hourly join serve both windows: the rows of the
    # union window are fetched once, then split by the exact bounds
    cur = _current(hourly, runs, snaps)
    local = to_local("as_of_utc", F.col("timezone"))
    cur = cur.select("*", hour_floor(local).alias("_h0"), day_floor(local).alias("_day"))
    h0, day = F.col("_h0"), F.col("_day")
    w12 = (h0, plus_hours(h0, rules.digest_horizon_hours))
    band = (plus_hours(day, rules.day_band_start_hour), plus_hours(day, rules.day_band_end_hour))
    rows = rows_in_windows(hourly, cur, F.least(w12[0], band[0]), F.greatest(w12[1], band[1]), _MEAS)
    # one aggregation: both windows and the few day parts of the band side by side
    ft = F.col("forecast_time_local")
    in12, in_band = (ft >= w12[0]) & (ft < w12[1]), (ft >= band[0]) & (ft < band[1])
    rows = rows.withColumn("_in12", in12).withColumn("_part", F.when(in_band, daypart_label(F.col("forecast_hour_local"), part_set)))
    names = [n for n, *_ in config.DAYPART_SETS[part_set]] + [n for n in (config.DAYPART_ELSE[part_set],) if n]
    wet = F.coalesce("precipitation_mm", F.lit(0.0))
    aggs = []
    for i, name in enumerate(names):
        own = F.col("_part") == name
        aggs += [exact_mean_rounded(F.when(own, F.col("temperature_c")), 0).alias(f"_t{i}"),
                 (F.max(F.when(own, wet)) > 0).alias(f"_wet{i}")]       # NULL: the part has no rows
    near = {c: F.when(F.col("_in12"), F.col(c)) for c in rows.columns}
    g = rows.groupBy(KEY, "as_of_utc", SNAP).agg(
        exact_mean(near["cloudcover_pct"]).alias("_c"),
        exact_mean_rounded(near["temperature_c"], 1).alias("avg_temp_c_12h"),
        exact_mean_rounded(near["feels_like_c"], 1).alias("avg_feels_like_c_12h"),
        exact_mean_rounded(near["cloudcover_pct"], 0).alias("avg_cloudcover_pct_12h"),
        (F.max(F.when(F.col("_in12"), wet)) > 0).alias("rain_possible"),
        F.round(F.max(near["wind_kmh"]), 0).alias("max_wind_kmh_12h"),
        F.min(near["forecast_time_local"]).alias("window_start_local"),
        F.max(near["forecast_time_local"]).alias("window_end_local"),
        F.count(F.when(F.col("_in12"), 1)).alias("n_hours"), *aggs)
    all_rainy = F.lit(True)
    for i in range(len(names)):
        all_rainy = all_rainy & F.coalesce(f"_wet{i}", F.lit(True))
    texts = [F.concat(F.lit(f"{name} "), F.col(f"_t{i}").cast("int").cast("string"), F.lit(config.DEGREE_C),
                      F.when(F.col(f"_wet{i}") & ~all_rainy, F.lit(config.RAIN_TAG)).otherwise(F.lit("")))
             for i, name in enumerate(names)]
    line = F.when(F.coalesce(*texts).isNotNull(), F.concat_ws(config.DAYPART_SEPARATOR, *texts))
    out = g.where("n_hours > 0").withColumn("dayparts_line", line).withColumn("sky_text", sky_text(F.col("_c")))
    cols = V2_COLUMNS[:-3] + ["dayparts_line"] + V2_COLUMNS[-3:]
    return out.withColumnRenamed("as_of_utc", "run_time_utc").select(*cols)


def brief_outbox(final: DataFrame, runs: DataFrame, log: DataFrame, rules: Rules = RULES,
                 force: bool = False, dry_run: bool = False) -> DataFrame:
    """Digest messages to deliver: one per (location, local date).

    Not before 07:00 local and only when the log has no row for that date;
    among several eligible runs of one day the first sends.  ``force`` and
    ``dry_run`` both skip these checks (every run gets its message);
    ``dry_run`` marks nothing to log.
    """
    local = to_local("run_time_utc", F.col("timezone"))
    r = runs.select(KEY, F.col("as_of_utc").alias("run_time_utc"), "timezone")
    f = final.join(r, [KEY, "run_time_utc"]).withColumn("sent_date_local", F.to_date(local)).withColumn(
        "_hour", F.hour(local))
    if not (force or dry_run):   # both flags skip the hour gate and the once-a-day check
        f = f.where(F.col("_hour") >= rules.digest_earliest_hour)
        f = f.join(log.select(KEY, "sent_date_local").distinct(), [KEY, "sent_date_local"], "left_anti")
        first = Window.partitionBy(KEY, "sent_date_local").orderBy("run_time_utc")
        f = f.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1)
    msg = brief_message(F.col(KEY), "avg_temp_c_12h", "avg_feels_like_c_12h", "sky_text", "rain_possible",
                        "max_wind_kmh_12h", "dayparts_line", rules.digest_wind_line_kmh)
    return f.select("sent_date_local", F.col("run_time_utc").alias("sent_time_utc"), KEY,
                    msg.alias("message"), F.lit(not dry_run).alias("to_log"))


# ---------------------------------------------------------------- day metrics
def _today_rows(hourly: DataFrame, runs: DataFrame, rules: Rules,
                snaps: DataFrame | None = None) -> DataFrame:
    """Today's hours (hour band 6-23) of each run's current snapshot: the band
    lies within one local date, so the join goes by date, a row for each run."""
    v = _current(hourly, runs, snaps)
    v = v.withColumn("run_date", F.to_date(to_local("as_of_utc", F.col("timezone"))))
    part = [PART] if PART in hourly.columns else []
    if part:  # as in rows_in_windows
        v = v.withColumn(PART, F.to_date(SNAP))
    h = hourly.where(F.col("forecast_hour_local").between(rules.profile_first_hour, rules.profile_last_hour))
    h = h.select(KEY, SNAP, *part, *_MEAS).withColumn("run_date", F.col("forecast_date_local"))
    return h.hint("merge").join(v, [*part, KEY, SNAP, "run_date"])


def _past_rows(hourly: DataFrame, runs: DataFrame, rules: Rules, days: int,
               snaps: DataFrame | None = None) -> DataFrame:
    return history_rows(hourly, runs, days, (rules.profile_first_hour, rules.profile_last_hour))


def daypart_summary(rows: DataFrame, part_set: str) -> DataFrame:
    lab = rows.withColumn("daypart", daypart_label(F.col("forecast_hour_local"), part_set))
    return lab.groupBy(KEY, "as_of_utc", F.col("forecast_date_local").alias("date_local"), "daypart").agg(
        exact_mean("temperature_c").alias("avg_temp_c"), exact_mean("feels_like_c").alias("avg_feels_like_c"),
        exact_mean("wind_kmh").alias("avg_wind_kmh"),
        F.sum(F.col("precipitation_mm").cast("decimal(38,9)")).cast("double").alias("total_precip_mm"),
        F.sum(F.when(F.col("precipitation_mm") > 0, 1).otherwise(0)).cast("bigint").alias("precip_hours"))


def daypart_summary_today(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                          snaps: DataFrame | None = None) -> DataFrame:
    return daypart_summary(_today_rows(hourly, runs, rules, snaps=snaps), "A")


def daypart_summary_yesterday(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                              snaps: DataFrame | None = None) -> DataFrame:
    return daypart_summary(_past_rows(hourly, runs, rules, 1), "B")


def compare_days(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                 snaps: DataFrame | None = None) -> DataFrame:
    """Today vs yesterday per day part (set B); both days must exist (inner)."""
    g = _part_sums(*_day_frames(hourly, runs, rules, snaps, days=1)).where("_h0 IS NOT NULL AND _h1 IS NOT NULL")
    mean = lambda m, b: _mean_of(F.col(f"_{m}_s{b}"), F.col(f"_{m}_c{b}"))
    g = g.select(KEY, "as_of_utc", "daypart", mean("t", 0).alias("today_temp"), mean("t", 1).alias("yday_temp"),
                 mean("w", 0).alias("today_wind"), mean("w", 1).alias("yday_wind"))
    return g.select(KEY, "as_of_utc", "daypart", "today_temp", "yday_temp",
                    (F.col("today_temp") - F.col("yday_temp")).alias("delta_temp"),
                    "today_wind", "yday_wind", (F.col("today_wind") - F.col("yday_wind")).alias("delta_wind"))


def _day_frames(hourly: DataFrame, runs: DataFrame, rules: Rules, snaps: DataFrame | None = None,
                days: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(today's rows, earlier days' rows with ``back`` = days before today)."""
    today = _today_rows(hourly, runs, rules, snaps=snaps).select(
        KEY, "as_of_utc", "run_date", "forecast_hour_local", "temperature_c", "wind_kmh", F.lit(0).alias("back"))
    past = _past_rows(hourly, runs, rules, days or rules.history_days).select(
        KEY, "as_of_utc", "run_date", "forecast_hour_local", "temperature_c", "wind_kmh",
        F.datediff("run_date", "forecast_date_local").alias("back"))
    return today, past


def _mean_of(total: Column, count: Column) -> Column:
    """``exact_mean`` from its decimal sum and count."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def _part_sums(today: DataFrame, past: DataFrame) -> DataFrame:
    """One aggregation for all day metrics: per (location, run, day part, set B)
    sums and counts of temperature and wind, today (0), yesterday (1) and on all
    earlier days (p), and whether today and yesterday have rows at all."""
    u = today.unionByName(past).withColumn("daypart", daypart_label(F.col("forecast_hour_local"), "B"))
    back = F.col("back")
    aggs = []
    for m, col in (("t", "temperature_c"), ("w", "wind_kmh")):
        for name, on in (("0", back == 0), ("1", back == 1), ("p", back >= 1)):
            x = F.when(on, F.col(col))
            aggs += [F.sum(x.cast("decimal(38,9)")).alias(f"_{m}_s{name}"), F.count(x).alias(f"_{m}_c{name}")]
    has = [F.max(F.when(back == b, F.lit(1))).alias(f"_h{b}") for b in (0, 1)]
    return u.groupBy(KEY, "as_of_utc", "run_date", "daypart").agg(*aggs, *has)


def _day_metrics(today: DataFrame, past: DataFrame) -> DataFrame:
    """Per run the means of today, yesterday and the earlier days, and the day
    part that changed most since yesterday (ties keep every part; a part must
    exist on both days; without one the run has a row with NULL)."""
    w = Window.partitionBy(KEY, "as_of_utc")   # the four day parts of a run
    mean = lambda b: _mean_of(F.sum(f"_t_s{b}").over(w), F.sum(f"_t_c{b}").over(w))
    both = F.col("_h0").isNotNull() & F.col("_h1").isNotNull()
    delta = F.when(both, _mean_of(F.col("_t_s0"), F.col("_t_c0")) - _mean_of(F.col("_t_s1"), F.col("_t_c1")))
    g = _part_sums(today, past).withColumn("_delta", delta).select(
        KEY, "as_of_utc", "run_date", "daypart", "_delta", mean(0).alias("today_avg_temp"), mean(1).alias("yday_avg_temp"),
        mean("p").alias("last4_avg_temp"), F.max("_h0").over(w).alias("_has_today"), F.max("_h1").over(w).alias("_has_yday"),
        F.max(F.abs("_delta")).over(w).alias("_most"), F.row_number().over(w.orderBy("daypart")).alias("_n"))
    top = F.abs("_delta") == F.col("_most")
    g = g.where(top | (F.col("_most").isNull() & (F.col("_n") == 1)))
    return g.withColumn("most_changed_daypart", F.when(top, F.col("daypart"))).withColumn("max_daypart_delta", F.when(top, F.col("_delta")))


def most_changed_daypart(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                         snaps: DataFrame | None = None) -> DataFrame:
    """Day part whose mean temperature moved most since yesterday, per run."""
    m = _day_metrics(*_day_frames(hourly, runs, rules, snaps, days=1))
    return m.where("_most IS NOT NULL").select(KEY, "as_of_utc", "most_changed_daypart", "max_daypart_delta")


def brief_metrics(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                  snaps: DataFrame | None = None) -> DataFrame:
    """Today's mean vs yesterday and the last 4 days, and the most changed part.

    "Today" is the run's local date; earlier days come from the newest
    snapshot at or before the run that has each hour."""
    m = _day_metrics(*_day_frames(hourly, runs, rules, snaps)).where(F.col("_has_today").isNotNull())
    return m.select(KEY, F.col("run_date").alias("today_date"), "today_avg_temp", "yday_avg_temp",
                    (F.col("today_avg_temp") - F.col("yday_avg_temp")).alias("delta_vs_yesterday"),
                    "last4_avg_temp", (F.col("today_avg_temp") - F.col("last4_avg_temp")).alias("delta_vs_last4days"),
                    "most_changed_daypart", "max_daypart_delta")


def last4_avg(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
              snaps: DataFrame | None = None) -> DataFrame:
    today, past = _day_frames(hourly, runs, rules, snaps)
    earlier = F.when(F.col("back") >= 1, F.col("temperature_c"))
    m = today.unionByName(past).groupBy(KEY, "as_of_utc", "run_date").agg(exact_mean(earlier).alias("last4_avg_temp"))
    return m.select(KEY, F.col("run_date").alias("today_date"), "last4_avg_temp")


def daily_headline(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                   snaps: DataFrame | None = None) -> DataFrame:
    """As ``brief_metrics`` with inner-join semantics: yesterday and a changed
    part must exist."""
    m = _day_metrics(*_day_frames(hourly, runs, rules, snaps)).where("_has_today IS NOT NULL AND _has_yday IS NOT NULL AND _most IS NOT NULL")
    return m.select(KEY, "today_avg_temp", "yday_avg_temp",
                    (F.col("today_avg_temp") - F.col("yday_avg_temp")).alias("delta_avg_temp"),
                    "most_changed_daypart", "max_daypart_delta")


def data_driven_today(hourly: DataFrame) -> DataFrame:
    """"Today" as the first forecast date of each location's newest snapshot."""
    from vintagecast.operators.versions import latest_snapshot_rows
    return latest_snapshot_rows(hourly).groupBy(KEY).agg(F.min("forecast_date_local").alias("today_date"))


def brief_metrics_faithful(hourly: DataFrame) -> DataFrame:
    """The source's literal rule (Q7): "today" is the first forecast date of
    the newest snapshot and every day is read from that snapshot only, so the
    earlier days are absent and their columns NULL.  Kept to document the
    difference; ``brief_metrics`` is the corrected rule."""
    from vintagecast.operators.versions import latest_snapshot_rows
    latest = latest_snapshot_rows(hourly)
    today = latest.groupBy(KEY).agg(F.min("forecast_date_local").alias("today_date"))
    rows = latest.join(today, KEY).where(F.col("forecast_hour_local").between(6, 23))
    back = F.datediff("today_date", "forecast_date_local")
    t = F.col("temperature_c")
    g = rows.groupBy(KEY, "today_date").agg(
        exact_mean(F.when(back == 0, t)).alias("today_avg_temp"),
        exact_mean(F.when(back == 1, t)).alias("yday_avg_temp"),
        exact_mean(F.when(back.between(1, 4), t)).alias("last4_avg_temp"),
        F.max(F.when(back == 0, 1)).alias("_has_today"))
    g = g.where(F.col("_has_today").isNotNull())
    return g.select(KEY, "today_date", "today_avg_temp", "yday_avg_temp",
                    (F.col("today_avg_temp") - F.col("yday_avg_temp")).alias("delta_vs_yesterday"),
                    "last4_avg_temp", (F.col("today_avg_temp") - F.col("last4_avg_temp")).alias("delta_vs_last4days"),
                    F.lit(None).cast("string").alias("most_changed_daypart"),
                    F.lit(None).cast("double").alias("max_daypart_delta"))
