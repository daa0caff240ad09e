"""Registration, keyed insert, degree / activity enrolment with postings, erasure."""

from datetime import date, datetime

from helpers import D, campus

from registrar.operators import ingest as I

USERS = [(1, "admin", "a@x", "admin"), (2, "student1", "s1@x", "student"), (3, "student2", "s2@x", "student"),
         (4, "prof1", "p@x", "instructor")]


def test_register_users_reasons_and_ids(spark):
    T = campus(spark, users=USERS, student=[(2, "A", None, None, None), (3, "B", None, None, None)])
    req = spark.createDataFrame(
        [(1, "new1", "n@x", True, None), (2, "student1", "x@x", True, None), (3, "new1", "n2@x", True, None),
         (4, "", "e@x", True, None), (5, "new2", None, True, None), (6, "new3", "e@x", False, None),
         (7, "new4", "e@x", True, True)],
        "seq long, username string, email string, password_present boolean, is_coordinator boolean")
    res = I.register_users(T, req, "instructor")
    st = {r.seq: (r.status, r.user_id) for r in res.outcome.collect()}
    assert st == {1: ("ok", 5), 2: ("username_exists", None), 3: ("duplicate_in_batch", None),
                  4: ("missing_fields", None), 5: ("missing_fields", None), 6: ("missing_fields", None),
                  7: ("ok", 6)}
    inst = {r.user_id: r.is_coordinator for r in res.tables["instructor"].collect()}
    assert inst == {5: False, 6: True}


def test_insert_if_absent(spark):
    target = campus(spark, users=USERS)["users"]
    rows = spark.createDataFrame([(5, "x", "1@x", "student"), (6, "x", "2@x", "student"), (7, "admin", "3@x", "admin"),
                                  (8, None, "4@x", "student")], "seq long, username string, email string, role string")
    out = {r.username: (r.user_id, r.email) for r in I.insert_if_absent(target, rows, ["username"], id_col="user_id").tables["target"].collect()}
    assert out["x"] == (5, "1@x") and out["admin"] == (1, "a@x") and len(out) == 5


def test_enroll_degree_posts_tuition_and_opens_accounts(spark):
    T = campus(spark, student=[(2, "A", None, None, None), (3, "B", None, None, None)],
               degree_program=[(1, "LEI", D(5000)), (2, "MCD", D(7000))],
               degree_enrollment=[(2, 1, date(2024, 9, 1))],
               financial_account=[(10, 2, D(5000), None)])
    req = spark.createDataFrame(
        [(1, 2, 2, date(2024, 9, 2)), (2, 3, 1, date(2024, 9, 2)), (3, 3, 1, date(2024, 9, 3)),
         (4, 2, 1, date(2024, 9, 4)), (5, 9, 1, date(2024, 9, 4)), (6, 3, 7, date(2024, 9, 4)), (7, 3, 2, None)],
        "seq long, student_id long, degree_id long, date date")
    res = I.enroll_degree(T, req, "2024-09-30")
    st = {r.seq: r.status for r in res.outcome.collect()}
    assert st == {1: "ok", 2: "ok", 3: "already_enrolled", 4: "already_enrolled", 5: "no_student",
                  6: "no_degree", 7: "missing_fields"}
    acc = {r.student_id: (r.account_id, r.balance) for r in res.tables["financial_account"].collect()}
    assert acc == {2: (10, D(12000)), 3: (11, D(5000))}   # second degree adds up; new account opened


def test_enroll_activity_fee_only_on_existing_account(spark):
    T = campus(spark, student=[(2, "A", None, None, None), (3, "B", None, None, None)], activity=[("chess", "Chess", D(25)), ("robots", "Robots", D(30))],
               financial_account=[(10, 2, D(100), None)], activity_participation=[(2, "chess", date(2024, 1, 1))])
    req = spark.createDataFrame([(1, 2, "robots"), (2, 3, "robots"), (3, 2, "chess"), (4, 2, "golf"), (5, 2, "robots")],
                                "seq long, student_id long, activity_id string")
    res = I.enroll_activity(T, req, "2024-10-01")
    st = {r.seq: (r.status, r.fee_posted) for r in res.outcome.collect()}
    assert st == {1: ("ok", True), 2: ("ok", False), 3: ("already_enrolled", None), 4: ("no_activity", None),
                  5: ("already_enrolled", None)}
    assert {r.student_id: r.balance for r in res.tables["financial_account"].collect()} == {2: D(130)}


def test_erase_students(spark):
    T = campus(spark, users=USERS, student=[(2, "A", None, None, None), (3, "B", None, None, None)],
               course_enrollment=[(2, 100, None, None, None), (3, 100, None, None, None)],
               financial_account=[(10, 2, D(1), None), (11, 3, D(1), None)],
               financial_transaction=[(1, 10, D(1), "t", datetime(2024, 1, 1), None, None),
                                      (2, 11, D(1), "t", datetime(2024, 1, 1), None, None)],
               student_class=[(2, 7)], degree_enrollment=[(2, 1, date(2024, 1, 1))])
    req = spark.createDataFrame([(1, 2), (2, 4), (3, 99)], "seq long, student_id long")
    res = I.erase_students(T, req)
    st = {r.student_id: r.status for r in res.outcome.collect()}
    assert st == {2: "ok", 4: "not_student", 99: "not_student"}
    assert [r.user_id for r in res.tables["users"].collect()] == [1, 3, 4]
    assert [r.account_id for r in res.tables["financial_transaction"].collect()] == [11]
    assert res.tables["student_class"].count() == 0
