"""Physical-plan properties: column pruning and filter pushdown reach the scans."""

import re

from __spark_entry__ import queries

from .conftest import SMALL


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan, table):
    return [m for m in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*" + table, plan)]


def test_item_means_read_three_lineitem_columns(spark):
    plan = _plan(queries()["ratings_avg_having"](spark, SMALL))
    cols = {c.split("#")[0] for s in _read_schemas(plan, "lineitem.parquet") for c in s.split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_quantity"}


def test_log_report_reads_only_line_fields(spark):
    plan = _plan(queries()["log_region_counts"](spark, SMALL))
    cols = {c.split("#")[0] for s in _read_schemas(plan, "events.parquet") for c in s.split(",")}
    assert cols == {"event_id", "ts", "user_id", "event_type", "value"}  # props is pruned


def test_split_cutoffs_push_into_scan(spark):
    plan = _plan(queries()["rank_table_union"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(ts,", plan)
