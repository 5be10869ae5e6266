"""Scale properties of the physical plans, checked for every registered query."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from vintagecast.operators import alerts, normalize
from vintagecast.plans import catalog
from vintagecast.sources import fixtures as fx

# these run streaming queries or write files while being built
SIDE_EFFECT_KEYS = {"read_envelopes", "newest_file", "stream_ingest", "stream_dedup", "stream_hour_counts",
                    "stream_change", "stream_change_by_snapshot", "stream_cooldown", "stream_alert", "stream_brief_once",
                    "append_alert_log", "append_brief_log", "append_health",
                    "rebuild_table", "create_if_missing"}
KEYS = sorted(k for k in catalog.QUERIES if k not in SIDE_EFFECT_KEYS)
TOP_K = ["latest_two_orders", "latest_two_snapshots", "cloud_range", "rows_per_snapshot_newest",
         "latest_raw", "registry_latest", "latest_rows_with_type"]


def _plan(spark, key: str) -> str:
    df = entry.queries()[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_pairwise_join(spark, key):
    plan = _plan(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", TOP_K)
def test_top_k_trims_before_shuffle(spark, key):
    plan = _plan(spark, key)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "latest_two_orders")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("o_totalprice" not in s and "o_orderpriority" not in s for s in schemas)
    plan = _plan(spark, "alert_replay")
    for s in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert "props" not in s and "event_type" not in s      # events columns the fixture does not use


def test_window_join_merges_exploded_sides(spark):
    """Rows behind ``explode`` are more than the planner takes them for: no side is broadcast."""
    h = fx.hourly(spark, SF_SMALL)
    rows = alerts.horizon_rows(h, fx.snapshots(h).withColumn("as_of_utc", F.col("snapshot_time_utc")), 6)
    join = re.search(r"(\w+) \[location_name[^\]]*_hf[^\]]*\]", rows._jdf.queryExecution().executedPlan().toString())
    assert join[1] == "SortMergeJoin" and rows.count() > 0


def test_a_payload_is_parsed_once(spark):
    raw = fx.raw_snapshots(fx.feed(spark, SF_SMALL))
    plan = normalize.normalize_hourly(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_feed_is_normalised_once(spark):
    assert "from_json" not in _plan(spark, "alert_feed")


def _exchanges(spark, df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [x for x in plan.splitlines() if re.search(r"\bExchange\b", x)]


def test_feed_payloads_are_built_where_their_events_meet(spark):
    """The hours of a snapshot aren't shuffled to be put together (F5 to F8: disk)."""
    assert len(_exchanges(spark, fx.feed_raw(spark, SF_SMALL))) == 1
    a, b = fx.feed_raw(spark, SF_SMALL), fx.raw_snapshots(fx.feed(spark, SF_SMALL))
    assert a.schema == b.schema and a.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_digest_joins_hourly_once(spark):
    """Both windows of a digest come out of one join and one aggregation (F5, F7: disk)."""
    plan = catalog.q_brief_final(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[location_name[^\]]*_hf", plan.split("== Initial Plan ==")[-1])) == 1


def test_a_window_asks_for_few_rows_of_the_grid(spark):
    """A run's window is two or three half days, not an hour each (F5 to F8: disk)."""
    h = fx.hourly(spark, SF_SMALL)
    v = fx.snapshots(h).withColumn("as_of_utc", F.col("snapshot_time_utc"))
    plan = alerts.horizon_rows(h, v, 12)._jdf.queryExecution().optimizedPlan().toString()
    assert "INTERVAL '12' HOUR" in plan and "INTERVAL '01' HOUR" not in plan
