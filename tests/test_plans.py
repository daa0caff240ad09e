"""Plan shape guards: no cartesian or nested-loop joins, no Python evaluation in any
registered query; rankings limit before the shuffle; scans are pruned."""

import importlib

import pytest

from registrar.plans.catalog import queries

E = importlib.import_module("__spark_entry__")
SMOKE = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


VARIANT = ("_after_", "_registered", "_chosen", "_degree", "_outcome", "_json", "_tables", "_faults", "_balances")


@pytest.mark.parametrize("name", sorted(n for n in queries() if not any(v in n for v in VARIANT)))
def test_no_forbidden_operators(spark, name, monkeypatch):
    """Also before each checkpoint, where the plan would be cut off."""
    from registrar.functions import sequence
    from registrar.operators import grading, ingest
    seen, real = [], sequence.materialize

    def watched(df):
        seen.append(plan(df))
        return real(df)

    for module in (sequence, grading, ingest):
        monkeypatch.setattr(module, "materialize", watched)
    for text in (plan(queries()[name](spark, SMOKE)), *seen):
        for op in FORBIDDEN:
            assert op not in text, (name, op)


def test_pass_mark_reaches_a_stored_scan(spark, tmp_path):
    from helpers import D, campus
    from registrar.functions.columns import passed
    campus(spark, course_enrollment=[(1, 1, D(10), None, None)])["course_enrollment"].write.parquet(f"{tmp_path}/e")
    text = plan(spark.read.parquet(f"{tmp_path}/e").where(passed("grade")))
    assert "GreaterThanOrEqual(grade,9.50)" in text


def test_rank_filter_limits_before_shuffle(spark):
    text = E.queries()["top_by_group"](spark, SMOKE)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in text


def test_scan_reads_only_used_columns(spark):
    import contextlib
    import io
    import re
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()["transcript"](spark, SMOKE).explain("formatted")
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", buf.getvalue())
    lineitem = [x for x in schemas if "l_orderkey" in x]
    assert lineitem, schemas
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_linestatus", "o_totalprice"):
        assert all(unused not in x for x in schemas), unused


@pytest.mark.parametrize("name", ["submit_grades", "stored_grades", "enrollment_after_grades", "academic_record", "admit_to_offering",
                                  "student_class_after_admission", "enrollment_after_admission"])
def test_shared_tables_are_derived_once(spark, name):
    """What several branches read is stored; none joins the lines and orders again."""
    assert "lineitem" not in plan(queries()[name](spark, SMOKE))
