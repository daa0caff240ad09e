"""Every derived domain / request table has exactly the declared columns and types."""

from registrar.schema import REQUEST_SCHEMAS, SCHEMAS
from registrar.sources.fixtures import Campus

DERIVED = ["users", "student", "instructor", "course", "course_edition", "course_enrollment",
           "instructor_assignment", "degree_program", "degree_enrollment", "degree_courses",
           "course_prerequisites", "class", "activity", "activity_participation", "financial_account",
           "financial_transaction", "student_class", "academic_record", "admin", "classroom", "class_assignment"]
REQUESTS = {"admission_request": "admission_request", "degree_request": "degree_request",
            "activity_request": "activity_request", "registration": "registration",
            "grade_batch": "grade_batch", "grade_row": "grade_row", "erasure_request": "erasure_request",
            "charge": "charge"}


def _shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_domain_tables_match_schema(spark):
    c = Campus(spark, "/root/testdata/sf0.001")
    for name in DERIVED:
        assert _shape(getattr(c, name).schema) == _shape(SCHEMAS[name]), name


def test_request_tables_match_schema(spark):
    c = Campus(spark, "/root/testdata/sf0.001")
    for attr, schema in REQUESTS.items():
        got = {n: t for n, t in _shape(getattr(c, attr).schema)}
        want = {n: t for n, t in _shape(REQUEST_SCHEMAS[schema])}
        assert got == want, attr


def test_derived_keys_are_unique(spark):
    c = Campus(spark, "/root/testdata/sf0.01")
    for df, keys in ((c.charge, ["charge_id"]), (c.grade_row, ["batch_id", "pos"]), (c.course, ["code"]), (c.course_edition, ["edition_id"])):
        assert df.count() == df.select(*keys).distinct().count(), keys


def test_every_outcome_occurs(spark):
    from registrar.operators.admission import STATUSES
    from registrar.operators.grading import BATCH_STATUSES
    from registrar.plans.catalog import queries
    sf = "/root/testdata/sf0.01"
    for name, want in (("admit_to_offering", STATUSES), ("submit_grades", set(BATCH_STATUSES) - {"incomplete"}),
                       ("insert_if_absent_outcome", ("ok", "null_key", "exists", "duplicate_in_batch")),
                       ("enroll_activity", ("ok", "no_activity", "already_enrolled", "no_student")),
                       ("activity_refunds", ("ok", "not_enrolled", "already_cancelled"))):
        assert {r.status for r in queries()[name](spark, sf).select("status").distinct().collect()} == set(want), name


def test_ids_of_people_are_disjoint_at_any_size(spark):
    """Customer keys beyond 1e9 (and beyond 4e9) meet no instructor, coordinator or admin."""
    from pyspark.sql import functions as F
    for shift in (0, 1_000_000_000, 15_000_000_000):
        c = Campus(spark, "/root/testdata/sf0.001")
        moved = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}
        for name, key in moved.items():
            c.src._cache[name] = c.src.table(name).withColumn(key, F.col(key) + shift)
        ids = c.users.select("user_id")
        assert ids.count() == ids.distinct().count()
        phantom = c.course_edition.select("coordinator_id").distinct().join(c.instructor, F.col("coordinator_id") == F.col("user_id"), "left_anti")
        assert phantom.count() > 0 and phantom.join(ids, F.col("coordinator_id") == F.col("user_id")).count() == 0
        unknown = c.erasure_request.join(ids, F.col("student_id") == F.col("user_id"), "left_anti")
        assert unknown.count() == c.src.customer.where((F.col("c_custkey") % 500) == 7).count()


def test_grade_batches_come_from_the_offerings_without_dealing_all_rows_again(spark):
    import datetime
    from types import SimpleNamespace

    from pyspark.sql import functions as F

    from registrar.sources.fixtures import MASKED, Campus

    c = Campus(spark, "/nowhere")
    ids = lambda name: spark.createDataFrame([(7,)], f"{name} long")
    c.src = SimpleNamespace(customer=ids("c_custkey"), supplier=ids("s_suppkey"), events=ids("user_id"))
    day = datetime.date(1996, 5, 1)
    some = [(part, supp, line, on) for part, supp, on in ((3, 2, day), (3, 1, day), (9, 4, day), (5, 3, None), (None, 2, day))
            for line in (1, 1, 7, MASKED, MASKED + 1, 99, None)]
    lines = spark.createDataFrame([(i, p, s, n, 10.0, "A", on, 1) for i, (p, s, n, on) in enumerate(some)],
                                  "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, "
                                  "l_returnflag string, ordered_on date, student_id long")
    c._memo["lines"] = lines
    c.keep("lines", "offering")
    got = sorted(map(tuple, c.grade_batch.collect()), key=str)
    b = c.enr0.select((F.col("edition_id") * 100 + F.col("l_linenumber")).alias("batch_id"), "edition_id", "l_linenumber").distinct()
    by_row = b.join(c.course_edition.select("edition_id", "coordinator_id"), "edition_id", "left").collect()
    assert len(got) == len(by_row)
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(((r.batch_id, r.edition_id, r.coordinator_id) for r in by_row), key=str)
    c._memo["lines"] = lines.where(F.col("l_linenumber").between(0, MASKED) & F.col("ordered_on").isNotNull() & F.col("l_partkey").isNotNull())
    del c._memo["enr0"], c._memo["grade_batch"]
    assert "Exchange" not in c.grade_batch._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
