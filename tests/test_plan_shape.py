"""What no plan may contain, with broadcasting of unhinted sides switched off as if every table were large."""

import pytest

from chartmill.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"

# Queries with a one-row result, a cursor, a numbering or the bits of a key filter; only pre-aggregated rows reach the single task.
ONE_TASK = {"latest_staged_row", "ledger_first_run_or_delta", "anti_not_staged_delta", "semi_of_delta", "latest_row", "find_triage", "find_users", "find_latest_events", "allocate_identifiers", "backfill_descending",
            "first_run_or_delta", "incr_ascending", "incr_inclusive", "incr_look_back"}
# Queries that write and read back: their returned plan is only the last read.
STAGED = {"load_ledger", "load_ledger_compacted", "minute_batches_waiting", "triage_by_changes", "regimens_by_changes", "upsert_ranges", "append_staged", "idempotent_load", "minute_batches", "upsert_mapping", "outbox_write"}


@pytest.fixture(scope="module", autouse=True)
def large_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STAGED))
def test_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert operator not in plan
    if name not in ONE_TASK:
        assert "SinglePartition" not in plan
    # The dictionaries are broadcast whatever the setting.
    if name in {"case_code_map", "dict_program", "dict_identifier_type", "job_encounters", "job_orders"}:
        assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name, columns", [
    ("project_alias", "struct<o_orderkey:bigint,o_custkey:bigint>"),
    ("pivot_vitals", "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>"),
    ("semi_migrated", "struct<c_custkey:bigint,c_acctbal:double>"),
    ("job_lab_concepts", "struct<l_orderkey:bigint,l_partkey:bigint>"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert columns in QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    plan = QUERIES["incr_ascending"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(event_id,ScalarSubquery" in plan
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in QUERIES["semi_migrated"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,key", [("job_orders", "_reason_key"), ("job_hiv_enrollment", "value#")])
def test_facts_are_not_shuffled_by_a_coded_value(spark, name, key):
    """The dictionary is broadcast after a check of its own, also without Spark's estimates."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and key in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
