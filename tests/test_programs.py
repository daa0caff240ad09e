"""P1-P5 on hand-made tables; unknown students in W12 and W13."""

from datetime import date

from helpers import D, campus

from registrar.operators.admission import admit_to_offering
from registrar.operators.ingest import enroll_activity, insert_if_absent, student_tables
from registrar.operators.programs import cancel_activities, charge_ledger, degree_progress, most_passed, program_restriction


def test_refunds_in_order(spark):
    T = campus(spark, activity=[("a", "a", D(20))], activity_participation=[(1, "a", date(2024, 1, 1)), (2, "a", date(2024, 1, 1))],
               financial_account=[(9, 1, D(50), None)])
    req = spark.createDataFrame([(3, 1, "a"), (1, 1, "a"), (2, 5, "a"), (4, 2, "a"), (5, None, "a")], "seq long, student_id long, activity_id string")
    res = cancel_activities(T, req, "2024-02-01")
    got = {r.seq: (r.status, r.fee_refunded) for r in res.outcome.collect()}
    assert got == {1: ("ok", True), 3: ("already_cancelled", None), 2: ("not_enrolled", None), 4: ("ok", False), 5: ("not_enrolled", None)}
    assert [r.balance for r in res.tables["financial_account"].collect()] == [D("30.00")]
    assert res.tables["activity_participation"].count() == 0
    assert sorted((r.student_id, r.amount) for r in res.tables["refund"].collect()) == [(1, D("-20.00")), (2, D("-20.00"))]


def test_ledger_balance_after_each_charge(spark):
    rows = [(1, 7, D(10), "tuition", date(2024, 1, 2)), (2, 7, D(5), "activity", date(2024, 1, 1)), (3, 7, D(-5), "cancellation", date(2024, 1, 3)),
            (4, 8, D(1), "activity", date(2024, 1, 1))]
    d = spark.createDataFrame(rows, "charge_id long, student_id long, amount decimal(10,2), kind string, charge_date date")
    assert {r.charge_id: r.balance_after for r in charge_ledger(d).collect()} == {2: D("5.00"), 1: D("15.00"), 3: D("10.00"), 4: D("1.00")}


def test_programme_progress_and_months(spark):
    T = campus(spark, course=[("A", "A", 6), ("B", "B", 4), ("C", "C", 3)], course_edition=[(1, "A", 2024, 9, None, 1), (2, "C", 2024, 9, None, 1)],
               degree_program=[(1, "x", D(1))], degree_courses=[(1, "A"), (1, "B")], degree_enrollment=[(5, 1, date(2024, 1, 1))],
               course_enrollment=[(5, 1, D(12), None, None), (5, 2, D(12), None, None), (6, 1, D(9), None, None)])
    assert {(r.student_id, r.edition_id): r.in_program for r in program_restriction(T, T["course_enrollment"]).collect()} == \
        {(5, 1): True, (5, 2): False, (6, 1): False}
    assert [(r.student_id, r.degree_id, r.credits_passed, r.credits_required) for r in degree_progress(T).collect()] == [(5, 1, 6, 10)]
    T["grade_date"] = spark.createDataFrame([(5, 1, date(2024, 6, 1)), (5, 2, date(2023, 6, 1)), (6, 1, date(2024, 6, 1))],
                                            "student_id long, edition_id long, graded_on date")
    assert [(r.course_code, r.passed) for r in most_passed(T, "2024-06-01").collect()] == [("A", 1)]
    assert [(r.course_code, r.passed) for r in most_passed(T, "2024-05-31").collect()] == [("C", 1)]


def test_unknown_students_are_refused_and_take_no_seat(spark):
    T = campus(spark, student=[(1, "s", None, None, None)], course=[("A", "A", 6)], course_edition=[(1, "A", 2024, 1, None, 1)],
               **{"class": [(10, 1, "T", "x")]}, activity=[("a", "a", D(2))])
    T["course_enrollment"] = T["course_enrollment"]
    req = spark.createDataFrame([(1, 999, 1, [10]), (2, 1, 1, [10])], "seq long, student_id long, edition_id long, classes array<long>")
    assert {r.seq: r.status for r in admit_to_offering(T, req).outcome.collect()} == {1: "no_student", 2: "ok"}
    act = spark.createDataFrame([(1, 999, "a"), (2, 1, "a")], "seq long, student_id long, activity_id string")
    assert {r.seq: r.status for r in enroll_activity(T, act, "2024-01-01").outcome.collect()} == {1: "no_student", 2: "ok"}


def test_null_keys_get_an_outcome(spark):
    T = campus(spark, users=[(1, "u", None, "student")])
    rows = spark.createDataFrame([(1, None, "e", "student"), (2, "u", "e", "student"), (3, "v", "e", "student"), (4, "v", "f", "student")],
                                 "seq long, username string, email string, role string")
    res = insert_if_absent(T["users"], rows, ["username"], id_col="user_id")
    assert {r.seq: r.status for r in res.outcome.collect()} == {1: "null_key", 2: "exists", 3: "ok", 4: "duplicate_in_batch"}
    assert sorted((r.user_id, r.username) for r in res.tables["target"].collect()) == [(1, "u"), (2, "v")]


def test_erased_tables_follow_the_foreign_keys():
    assert dict(student_tables()) == {
        "academic_record": "student_id", "activity_participation": "student_id", "course_enrollment": "student_id",
        "degree_enrollment": "student_id", "financial_account": "student_id", "financial_transaction": "account_id",
        "student": "user_id", "student_class": "student_id", "users": "user_id"}
