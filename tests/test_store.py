"""Stored layout: year-partitioned enrolments give the same reports, pruned by year."""

import tempfile

from pyspark.sql import functions as F

from registrar.operators import reports as R
from registrar.operators.admission import admit_to_offering
from registrar.sources.fixtures import Campus
from registrar.sources.store import load_tables, store_tables

NAMES = ("student", "course", "course_edition", "course_enrollment", "activity", "activity_participation",
         "class", "course_prerequisites", "student_class")


def test_stored_reports_equal_and_pruned(spark):
    c = Campus(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="registrar-store-", dir="/tmp")
    store_tables(c, root, NAMES)
    T = load_tables(spark, root, NAMES)
    assert "year" in T["course_enrollment"].columns
    for fn in (lambda t: R.top_n_by_average(t, 2000, 5),
               lambda t: R.evaluation_stats(t, "2001-12-31"),
               lambda t: R.top_n_details(t, 2000, 3).select("student_id", F.size("grades").alias("g"))):
        assert sorted(map(tuple, fn(T).collect())) == sorted(map(tuple, fn(c).collect()))
    plan = R.top_n_by_average(T, 2000, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 2000)" in plan
    out = admit_to_offering(T, c.admission_request)
    assert "year" in out.tables["course_enrollment"].columns
    assert out.tables["course_enrollment"].where(F.col("year").isNull()).count() == 0


def _scans(plan):
    """The file scans of an executed plan, those inside query stages too."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _scans(plan.finalPhysicalPlan())
    if name.endswith("QueryStageExec"):
        return _scans(plan.plan())
    if name == "FileSourceScanExec":
        return [plan]
    kids = plan.children()
    return [s for i in range(kids.size()) for s in _scans(kids.apply(i))]


def test_roster_reads_only_the_years_of_the_chosen_offerings(spark):
    """The offerings are known at run time only; still one year's folder is read."""
    c = Campus(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="registrar-store-", dir="/tmp")
    names = ("course", "course_edition", "course_enrollment")
    store_tables(c, root, names)
    T = load_tables(spark, root, names)
    R.best_offering(T, "1992-12-31").write.parquet(f"{root}/best")
    best = spark.read.parquet(f"{root}/best").where(F.col("approved") > 0)
    out = R.roster(T, best)
    rows = out.collect()
    top = best.first()
    want = c.course_enrollment.where(F.col("edition_id") == top.edition_id).select(*out.columns)
    assert sorted(map(str, rows)) == sorted(map(str, want.collect())) and len(rows) >= top.approved > 0
    plan = out._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    read = [s.metrics().apply("numPartitions").value() for s in _scans(plan) if s.metrics().contains("numPartitions")]
    assert read == [1] and T["course_enrollment"].select("year").distinct().count() > 1
