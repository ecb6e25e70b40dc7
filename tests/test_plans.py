"""Plan checks: pushdown and pruning reach the Parquet scan, no Python in the JVM-side operators."""

import __spark_entry__ as entry
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_pushdown_and_column_pruning(spark):
    text = _formatted(entry.queries()["roles_of_kind"](spark, SF_SMALL))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text and "GreaterThan(o_custkey,0)" in text
    text = _formatted(entry.queries()["users_with_roles"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_parse_reads_only_needed_event_columns(spark):
    text = _formatted(entry.queries()["log_parse"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in text


def test_no_python_in_jvm_side_queries(spark):
    jvm_only = ["log_parse", "log_rejects", "log_event_time", "payload_encode", "payload_decode",
                "payload_decode_single", "payload_quarantine", "users_with_roles", "users_upsert", "users_validate",
                "users_audit", "users_update", "users_delete"]
    for name in jvm_only:
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in plan, (name, node)


def test_upsert_and_left_join_have_no_window_or_cartesian(spark):
    for name in ("users_upsert", "users_with_roles", "users_validate"):
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        assert "Window" not in plan and "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan, name
