from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from vintagecast.session import configure
    s = (SparkSession.builder.master("local[*]").appName("vintagecast-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


HOURLY_SCHEMA = ("location_name string, snapshot_time_utc timestamp_ntz, timezone string, idx bigint, "
                 "forecast_time_local timestamp_ntz, forecast_date_local date, forecast_hour_local bigint, "
                 "temperature_c double, feels_like_c double, precipitation_mm double, wind_kmh double, "
                 "cloudcover_pct double")


def hourly_rows(spark, rows):
    """rows: (location, snapshot iso, forecast iso, temp, precip, wind, cloud)."""
    out = []
    for i, (loc, snap, ft, temp, precip, wind, cloud) in enumerate(rows):
        f = ts(ft)
        out.append((loc, ts(snap), "UTC", i, f, f.date(), f.hour, temp, temp, precip, wind, cloud))
    return spark.createDataFrame(out, HOURLY_SCHEMA)


def runs_df(spark, rows):
    return spark.createDataFrame([(loc, "UTC", ts(a)) for loc, a in rows],
                                 "location_name string, timezone string, as_of_utc timestamp_ntz")
