"""Every registered query against its independent DuckDB SQL at sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_check import compare
from vintagecast.plans import catalog

KEYS = sorted(catalog.QUERIES)


def test_every_key_has_oracle_or_is_declared_rows_only():
    sql = entry.oracle_sql()
    missing = set(KEYS) - set(sql)
    assert missing == entry.NO_ORACLE


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    res = compare(spark, SF_CHECK, [key], verbose=False)[key]
    assert res.startswith("ok") or res.startswith("rows-only"), res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["sent_time_utc", "alert_type", "snapshot_time_utc", "message", "location_name"]
    assert df.count() >= 0


def test_queries_run_on_smallest_scale(spark):
    # the whole catalog also runs on sf0.001 (sparser data, more NULL paths)
    res = compare(spark, SF_SMALL, ["alert_replay", "brief_final", "snapshot_health", "cooldown_replay",
                                    "brief_metrics", "normalize_hourly"], verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad
