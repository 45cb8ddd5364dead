"""What the plans must and must not contain."""

import pytest

from sensorloom.plans.catalog import QUERIES

CHAINED = {
    "cooldown_alerts", "cooldown_six_hours", "cooldown_dense", "cooldown_seeded", "alerts_table", "alert_counts",
    "alerts_union", "render_alert", "retry_alerts", "render_retry",
}
EAGER = {  # these run jobs while they are built
    "csv_scan", "csv_scan_headers", "archive_roundtrip", "alerts_by_filter", "outbox_cycle", "topic_read_from", "table_contract",
    "alert_outbox_cycle", "stream_cooldown_alerts", "restart_exactly_once", "late_drop",
    "stream_cooldown_batches", "replay_exactly_once", "late_alerts", "alerts_repeated_delivery",
    "stream_observed", "consumer_lag_live", "archive_compacted",
    "daily_summary_incremental", "outbox_poison",
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_row_python_and_no_products(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for banned in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text
    if name not in CHAINED:
        assert "Arrow" not in text and "InPandas" not in text


def test_top_k_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(QUERIES["outbox_top10"](spark, sf))


def test_small_dimension_is_broadcast(spark, sf):
    assert "BroadcastHashJoin" in plan(QUERIES["assign_partition"](spark, sf))


def test_scan_reads_only_needed_columns(spark, sf):
    text = plan(QUERIES["topic_tps_counted"](spark, sf))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_cooldown_shuffles_its_events_once(spark, sf):
    frame = QUERIES["cooldown_alerts"](spark, sf)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert final.count("ReusedExchange") >= 2


def test_costly_columns_are_computed_once(spark, sf):
    """A JSON parse must not be copied into the filters that use its result."""
    text = plan(QUERIES["retry_alerts"](spark, sf))
    assert len(text) < 200_000
    scans = text.count("FileScan parquet")
    assert text.count("from_json") <= 2 * scans
