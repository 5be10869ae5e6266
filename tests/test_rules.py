"""Hand-made edge cases with expected rows (FIXTURES.md part 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import hourly_rows, runs_df, ts
from vintagecast import config
from vintagecast.functions import columns as C
from vintagecast.operators import alerts, brief, gating, health

S1, S2 = "2024-03-01 00:00:00", "2024-03-01 01:00:00"
NOW = "2024-03-01 06:00:00"


def _decide(spark, rows, now=NOW):
    h = hourly_rows(spark, rows)
    return alerts.decisions(h, runs_df(spark, [("L", now)])).collect()[0]


def test_no_previous_snapshot_no_alert(spark):
    r = _decide(spark, [("L", S1, "2024-03-01 07:00:00", 1.0, 2.0, 40.0, 0.0)])
    assert r.current_rain_next6h == 1 and r.prev_rain_next6h is None
    assert r.should_alert_rain_next6h is False and r.should_alert_wind_next6h is False


def test_null_rain_counts_dry_and_rise(spark):
    r = _decide(spark, [
        ("L", S1, "2024-03-01 07:00:00", 1.0, None, 15.0, 0.0),
        ("L", S2, "2024-03-01 07:00:00", 1.0, 0.5, 30.0, 0.0),
    ])
    assert r.prev_rain_next6h == 0 and r.current_rain_next6h == 1
    assert r.should_alert_rain_next6h is True
    # wind exactly 30 and rise exactly 15 -> alert
    assert r.should_alert_wind_next6h is True


def test_window_is_half_open(spark):
    r = _decide(spark, [
        ("L", S1, "2024-03-01 06:00:00", 1.0, 0.0, 10.0, 0.0),   # == now: in
        ("L", S1, "2024-03-01 12:00:00", 1.0, 5.0, 90.0, 0.0),   # == now + 6h: out
        ("L", S2, "2024-03-01 06:00:00", 1.0, 0.0, 10.0, 0.0),
        ("L", S2, "2024-03-01 12:00:00", 1.0, 5.0, 90.0, 0.0),
    ])
    assert r.current_rain_next6h == 0 and r.current_max_wind_next6h == 10.0


def test_same_window_for_both_versions(spark):
    # previous snapshot's rain lies outside the run's window -> judged dry
    r = _decide(spark, [
        ("L", S1, "2024-03-01 05:00:00", 1.0, 3.0, 10.0, 0.0),
        ("L", S1, "2024-03-01 08:00:00", 1.0, 0.0, 10.0, 0.0),
        ("L", S2, "2024-03-01 08:00:00", 1.0, 1.0, 10.0, 0.0),
    ])
    assert r.prev_rain_next6h == 0 and r.should_alert_rain_next6h is True


def test_current_without_rows_in_window_keeps_row(spark):
    r = _decide(spark, [
        ("L", S1, "2024-03-01 07:00:00", 1.0, 0.0, 10.0, 0.0),
        ("L", S2, "2024-03-01 20:00:00", 1.0, 1.0, 10.0, 0.0),
    ])
    assert r.current_snapshot_utc is None and r.should_alert_rain_next6h is False


def test_snapshot_after_run_is_invisible(spark):
    r = _decide(spark, [
        ("L", S1, "2024-03-01 07:00:00", 1.0, 0.0, 10.0, 0.0),
        ("L", "2024-03-01 09:00:00", "2024-03-01 07:00:00", 1.0, 1.0, 10.0, 0.0),
    ])
    assert r.current_snapshot_utc == ts(S1) and r.prev_snapshot_utc is None


def test_cooldown_boundary(spark):
    d = spark.createDataFrame(
        [("L", ts("2024-03-01 10:00:00"), True), ("L", ts("2024-03-01 10:30:00"), True)],
        "location_name string, run_time_utc timestamp_ntz, should_alert_rain_next6h boolean")
    log = spark.createDataFrame([(ts("2024-03-01 08:00:00"), config.RAIN_ALERT_TYPE, None, "", "L")],
                                "sent_time_utc timestamp_ntz, alert_type string, snapshot_time_utc timestamp_ntz, "
                                "message string, location_name string")
    g = {r.run_time_utc.minute: r for r in gating.gated(d, log, config.RAIN_ALERT_TYPE,
                                                         "should_alert_rain_next6h").collect()}
    assert g[0].in_cooldown is False and g[0].should_send_after_gating is True   # exactly 2h
    assert g[30].in_cooldown is False


def test_cooldown_never_sent_is_open(spark):
    d = spark.createDataFrame([("L", ts("2024-03-01 10:00:00"), True)],
                               "location_name string, run_time_utc timestamp_ntz, should_alert_rain_next6h boolean")
    log = spark.createDataFrame([], "sent_time_utc timestamp_ntz, alert_type string, snapshot_time_utc timestamp_ntz, "
                                    "message string, location_name string")
    r = gating.gated(d, log, config.RAIN_ALERT_TYPE, "should_alert_rain_next6h").collect()[0]
    assert r.last_sent_time_utc is None and r.in_cooldown is False and r.should_send_after_gating is True


def _sequential_cooldown(times, hours=2):
    sent, last = [], None
    for t in sorted(times):
        ok = last is None or t >= last + dt.timedelta(hours=hours)
        sent.append(ok)
        last = t if ok else last
    return sent


def test_cooldown_replay_matches_sequential_fold(spark):
    base = ts("2024-03-01 00:00:00")
    mins = [0, 30, 119, 120, 121, 240, 241, 600, 601, 602, 1440, 1441, 1560, 1561, 3000]
    rows = [("L", "rain", base + dt.timedelta(minutes=m), i) for i, m in enumerate(mins)]
    rows += [("M", "rain", base + dt.timedelta(minutes=m * 7), 100 + i) for i, m in enumerate(mins)]
    df = spark.createDataFrame(rows, "location_name string, alert_type string, decision_time_utc timestamp_ntz, "
                                     "decision_id bigint")
    got = {r.decision_id: r.should_send_after_gating for r in gating.cooldown_replay(df).collect()}
    for loc, off in (("L", 0), ("M", 100)):
        times = [t for l_, _, t, _ in rows if l_ == loc]
        exp = _sequential_cooldown(times)
        assert [got[off + i] for i in range(len(mins))] == exp


def test_daypart_sets_hour_14():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    r = spark.range(1).select(*[C.daypart_label(F.lit(14), s).alias(s) for s in "ABC"],
                              C.daypart_label(F.lit(3), "A").alias("a3"),
                              C.daypart_label(F.lit(3), "B").alias("b3")).collect()[0]
    assert (r.A, r.B, r.C, r.a3, r.b3) == ("noon", "afternoon", "noon", "other", None)


def test_sky_text_bounds(spark):
    df = spark.createDataFrame([(20.0,), (60.0,), (None,), (60.5,)], "c double")
    assert [r.s for r in df.select(C.sky_text("c").alias("s")).collect()] == [
        "clear", "partly cloudy", "unknown", "cloudy"]


def test_brief_message_lines(spark):
    df = spark.createDataFrame([("P", 12.3, 11.0, "clear", True, 25.0, "noon 12°C"),
                                ("P", None, None, None, False, 24.0, "")],
                               "l string, t double, f double, s string, r boolean, w double, d string")
    msgs = [r.m for r in df.select(C.brief_message("l", "t", "f", "s", "r", "w", "d", 25).alias("m")).collect()]
    assert msgs[0] == ("Morning brief (P): 12.3°C (feels like 11.0°C)\nSky: clear\nRain: possible\n"
                       "Wind: up to 25 km/h\nDayparts: noon 12°C")
    assert msgs[1] == "Morning brief (P): (temperature unavailable)\nSky: unknown"


def test_wind_message_half_even(spark):
    df = spark.createDataFrame([(36.5,), (37.5,), (None,)], "w double")
    got = [r.m for r in df.select(C.wind_alert_message("w").alias("m")).collect()]
    assert got == [config.WIND_MESSAGE_FMT % "36", config.WIND_MESSAGE_FMT % "38", config.WIND_MESSAGE_PLAIN]


def test_dayparts_all_rainy_drops_tags(spark):
    rows = [("L", S1, f"2024-03-01 {h:02d}:00:00", 5.0, 1.0, 5.0, 10.0) for h in (8, 13, 16, 20)]
    some = [("M", S1, f"2024-03-01 {h:02d}:00:00", 5.0, 1.0 if h == 8 else 0.0, 5.0, 10.0) for h in (8, 13, 16, 20)]
    h = hourly_rows(spark, rows + some)
    r = runs_df(spark, [("L", "2024-03-01 07:00:00"), ("M", "2024-03-01 07:00:00")])
    got = {x.location_name: x.dayparts_line for x in brief.brief_final(h, r).collect()}
    assert got["L"] == "morning 5°C • noon 5°C • afternoon 5°C • evening 5°C"
    assert got["M"] == "morning 5°C (rain) • noon 5°C • afternoon 5°C • evening 5°C"


def test_health_silent_day_and_nothing_missing(spark):
    reg = [("L", ts(f"2024-03-01 {h:02d}:10:00"), f"a{h}", "x") for h in range(5, 19)]   # 06..19 Prague
    reg += [("L", ts(f"2024-03-03 {h:02d}:10:00"), f"c{h}", "x" if h % 2 else "y") for h in (5, 6)]
    df = spark.createDataFrame(reg, "location_name string, snapshot_time_utc timestamp_ntz, raw_file string, "
                                    "content_hash string")
    out = {r.today_local_date.day: r for r in health.snapshot_health(df, F.lit("Europe/Prague")).collect()}
    assert out[1].missing_hour_count_06_19 == 0 and out[1].missing_hours_list is None
    assert out[1].change_rate_pct_today == 0.0
    assert out[2].snapshots_today == 0 and out[2].missing_hour_count_06_19 == 14
    assert out[2].change_rate_pct_today is None
    assert out[3].change_rate_pct_today == 100.0
    assert out[3].missing_hours_list.startswith("08:00, 09:00")


def test_health_of_feeds_that_stopped(spark):
    reg = [("L", ts("2024-03-01 05:10:00"), "a", "x"), ("M", ts("2024-03-03 05:10:00"), "b", "x")]
    df = spark.createDataFrame(reg, "location_name string, snapshot_time_utc timestamp_ntz, raw_file string, "
                                    "content_hash string")
    out = {(r.location_name, r.today_local_date.day): r for r in health.snapshot_health(df, F.lit("Europe/Prague")).collect()}
    assert set(out) == {("L", 1), ("L", 2), ("L", 3), ("M", 3)}
    assert out["L", 3].missing_hour_count_06_19 == 14 and out["L", 3].snapshots_today == 0
    dates = spark.createDataFrame([("L", "2024-03-03"), ("M", "2024-03-03"), ("N", "2024-03-03")],
                                  "location_name string, d string").selectExpr("location_name", "date(d) AS today_local_date")
    out = {r.location_name: r for r in health.snapshot_health(df, F.lit("Europe/Prague"), dates=dates).collect()}
    assert [out[k].missing_hour_count_06_19 for k in "LMN"] == [14, 13, 14] and out["N"].snapshots_today == 0


def test_most_changed_daypart_keeps_ties(spark):
    rows = []
    for h, (t_today, t_yday) in {8: (10.0, 8.0), 12: (10.0, 12.0), 15: (10.0, 10.0), 20: (10.0, 9.0)}.items():
        rows.append(("L", "2024-03-02 00:00:00", f"2024-03-02 {h:02d}:00:00", t_today, 0.0, 5.0, 1.0))
        rows.append(("L", "2024-03-01 00:00:00", f"2024-03-01 {h:02d}:00:00", t_yday, 0.0, 5.0, 1.0))
    h = hourly_rows(spark, rows)
    r = runs_df(spark, [("L", "2024-03-02 06:00:00")])
    got = sorted((x.most_changed_daypart, x.max_daypart_delta) for x in brief.most_changed_daypart(h, r).collect())
    assert got == [("morning", 2.0), ("noon", -2.0)]


def test_faithful_metrics_have_no_history(spark):
    from tests.conftest import SF_CHECK
    from vintagecast.sources import fixtures as fx
    h = fx.hourly(spark, SF_CHECK)
    rows = brief.brief_metrics_faithful(h).collect()
    assert len(rows) > 5
    assert all(r.yday_avg_temp is None and r.last4_avg_temp is None for r in rows)
    # the corrected rule finds yesterday in the older snapshots
    fixed = brief.brief_metrics(h, fx.final_runs(h)).collect()
    assert any(r.yday_avg_temp is not None for r in fixed)


def test_health_up_to_leaves_future_hours_out(spark):
    reg = [("L", ts("2024-03-01 05:10:00"), "a", "x")]                  # 06:10 Prague
    df = spark.createDataFrame(reg, "location_name string, snapshot_time_utc timestamp_ntz, raw_file string, "
                                    "content_hash string")
    full = health.snapshot_health(df, F.lit("Europe/Prague")).collect()[0]
    cut = health.snapshot_health(df, F.lit("Europe/Prague"),
                                 up_to_local=F.lit("2024-03-01 08:30:00").cast("timestamp_ntz")).collect()[0]
    assert full.missing_hour_count_06_19 == 13
    assert cut.missing_hour_count_06_19 == 2 and cut.missing_hours_list == "07:00, 08:00"


def test_hash_scope_hourly_ignores_request_fields(spark):
    from vintagecast.sources import envelopes
    a = '{"generationtime_ms": 1.5, "hourly": {"time": ["t"], "temperature_2m": [1.0]}}'
    b = '{"generationtime_ms": 9.0, "hourly": {"time": ["t"], "temperature_2m": [1.0]}, "latitude": 2.0}'
    raw = spark.createDataFrame([("L", ts(S1), "a", a), ("L", ts(S2), "b", b)],
                                "location_name string, snapshot_time_utc timestamp_ntz, raw_file string, "
                                "payload_json string")
    whole = {r.raw_file: r.content_hash for r in envelopes.registry_rows(raw).collect()}
    hourly = {r.raw_file: r.content_hash for r in envelopes.registry_rows(raw, scope="hourly").collect()}
    assert whole["a"] != whole["b"] and hourly["a"] == hourly["b"]


def test_approx_quantiles_close_to_exact(spark):
    from tests.conftest import SF_CHECK
    from vintagecast.operators import profile
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    m, q = {"l_quantity": "qty"}, {"l_quantity": [0.5]}
    exact = {r.l_returnflag: r.qty_p50 for r in profile.distribution_profile(li, "l_returnflag", m, q).collect()}
    approx = {r.l_returnflag: r.qty_p50 for r in
              profile.distribution_profile(li, "l_returnflag", m, q, approx_accuracy=10000).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= 1.0 for k in exact)


def test_explicit_snapshot_list_equals_derived(spark):
    from tests.conftest import SF_SMALL
    from vintagecast.operators import versions
    from vintagecast.sources import fixtures as fx
    h = fx.hourly(spark, SF_SMALL)
    r = fx.runs(h)
    snaps = versions.snapshot_list(h).select("location_name", "snapshot_time_utc")   # e.g. from the registry
    a = alerts.decisions(h, r)
    b = alerts.decisions(h, r, snaps=snaps)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = brief.brief_final(h, r, snaps=snaps)
    assert c.exceptAll(brief.brief_final(h, r)).count() == 0


def test_brief_outbox_flags(spark):
    from vintagecast.schemas import BRIEF_LOG
    rows = [("L", S1, f"2024-03-01 {h:02d}:00:00", 5.0, 0.0, 5.0, 10.0) for h in range(6, 24)]
    h = hourly_rows(spark, rows)
    r = runs_df(spark, [("L", "2024-03-01 06:00:00"), ("L", "2024-03-01 08:00:00"), ("L", "2024-03-01 09:00:00")])
    final = brief.brief_final(h, r)
    empty = spark.createDataFrame([], BRIEF_LOG)
    logged = spark.createDataFrame([(dt.date(2024, 3, 1), ts("2024-03-01 07:30:00"), "L", "x")], BRIEF_LOG)
    normal = brief.brief_outbox(final, r, empty).collect()
    assert [x.sent_time_utc.hour for x in normal] == [8] and normal[0].to_log is True   # 06:00 gated, 09:00 second
    assert brief.brief_outbox(final, r, logged).count() == 0                            # already sent today
    forced = brief.brief_outbox(final, r, logged, force=True).collect()
    assert len(forced) == 3 and all(x.to_log for x in forced)
    dry = brief.brief_outbox(final, r, logged, dry_run=True).collect()
    assert len(dry) == 3 and not any(x.to_log for x in dry)
