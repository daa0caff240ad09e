"""Table schemas and fixed values of the academic-records domain.

The 20 declared tables plus ``student_class`` (used but never declared by the
reference), with the drifted columns declared: ``course_enrollment.evaluation_period``,
``financial_account.last_update``, ``academic_record.degree_id/enrollment_date``.
Keys are ``long`` throughout (keys taken from test data are 64-bit).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# Fixed values of the domain (must equal the reference's for right results).
PASS_MARK = Decimal("9.50")  # a grade >= 9.5 on the 0-20 scale passes; of the grades' type, so the filter is pushed down
GRADE_MIN = 0.0
GRADE_MAX = 20.0
ROLES = ("student", "instructor", "admin")
CLASS_TYPES = ("T", "PL")
COURSE_CODE_MAX_LEN = 10
GRADE_TYPE = T.DecimalType(5, 2)    # NUMERIC(5,2): grade, average
MONEY_TYPE = T.DecimalType(10, 2)   # NUMERIC(10,2): fees, balances, amounts

L, S, I, B, D, TS = (T.LongType(), T.StringType(), T.IntegerType(), T.BooleanType(),
                     T.DateType(), T.TimestampNTZType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SCHEMAS: dict[str, T.StructType] = {
    "users": _st(("user_id", L, False), ("username", S, False), ("email", S, True), ("role", S, False)),
    "student": _st(("user_id", L, False), ("name", S, True), ("birth_date", D, True),
                   ("address", S, True), ("district", S, True)),
    "instructor": _st(("user_id", L, False), ("is_coordinator", B, False)),
    "admin": _st(("user_id", L, False)),
    "academic_record": _st(("record_id", L, False), ("student_id", L, False), ("average", GRADE_TYPE, True),
                           ("approved_courses", L, True), ("current_semester", L, True),
                           ("degree_id", L, True), ("enrollment_date", D, True)),
    "degree_program": _st(("degree_id", L, False), ("name", S, False), ("tuition_fee", MONEY_TYPE, False)),
    "financial_account": _st(("account_id", L, False), ("student_id", L, False), ("balance", MONEY_TYPE, False),
                             ("last_update", TS, True)),
    "course": _st(("code", S, False), ("name", S, False), ("credits", L, False)),
    "course_edition": _st(("edition_id", L, False), ("course_code", S, False), ("year", L, False),
                          ("capacity", L, False), ("schedule", S, True), ("coordinator_id", L, False)),
    "class": _st(("class_id", L, False), ("edition_id", L, False), ("type", S, False), ("schedule", S, False)),
    "classroom": _st(("room_id", L, False), ("building", S, False), ("capacity", L, False), ("location", S, False)),
    "class_assignment": _st(("class_id", L, False), ("room_id", L, False)),
    "activity": _st(("activity_id", S, False), ("name", S, False), ("fee", MONEY_TYPE, False)),
    "degree_enrollment": _st(("student_id", L, False), ("degree_id", L, False), ("enrollment_date", D, False)),
    "course_enrollment": _st(("student_id", L, False), ("edition_id", L, False), ("grade", GRADE_TYPE, True),
                             ("attendance", L, True), ("evaluation_period", S, True)),
    "activity_participation": _st(("student_id", L, False), ("activity_id", S, False),
                                  ("registration_date", D, False)),
    "instructor_assignment": _st(("instructor_id", L, False), ("edition_id", L, False),
                                 ("is_coordinator", B, False)),
    "course_prerequisites": _st(("course_code", S, False), ("prerequisite_code", S, False)),
    "degree_courses": _st(("degree_id", L, False), ("course_code", S, False)),
    "financial_transaction": _st(("transaction_id", L, False), ("account_id", L, False),
                                 ("amount", MONEY_TYPE, False), ("description", S, False),
                                 ("transaction_date", TS, False), ("activity_id", S, True),
                                 ("degree_id", L, True)),
    "student_class": _st(("student_id", L, False), ("class_id", L, False)),
}

# Request tables (JSON bodies in the reference; one row per request, `seq` = arrival order).
REQUEST_SCHEMAS: dict[str, T.StructType] = {
    "registration": _st(("seq", L, False), ("username", S, True), ("email", S, True),
                        ("password_present", B, True), ("is_coordinator", B, True)),
    "degree_request": _st(("seq", L, False), ("student_id", L, True), ("degree_id", L, True), ("date", D, True)),
    "activity_request": _st(("seq", L, False), ("student_id", L, True), ("activity_id", S, True)),
    "admission_request": _st(("seq", L, False), ("student_id", L, True), ("edition_id", L, True),
                             ("classes", T.ArrayType(L), True)),
    "grade_batch": _st(("batch_id", L, False), ("edition_id", L, True), ("submitter_id", L, True),
                       ("period", S, True)),
    "grade_row": _st(("batch_id", L, False), ("pos", L, False), ("pair", T.ArrayType(S), True)),
    "erasure_request": _st(("seq", L, False), ("student_id", L, True)),
    "charge": _st(("charge_id", L, False), ("student_id", L, False), ("amount", MONEY_TYPE, False),
                  ("kind", S, False), ("charge_date", D, True)),
    "grade_change": _st(("student_id", L, False), ("edition_id", L, False), ("grade", GRADE_TYPE, True),
                        ("batch_id", L, False), ("pos", L, False)),
}

# Primary keys (composite where the DDL says so).
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "users": ("user_id",), "student": ("user_id",), "instructor": ("user_id",), "admin": ("user_id",),
    "academic_record": ("record_id",), "degree_program": ("degree_id",), "financial_account": ("account_id",),
    "course": ("code",), "course_edition": ("edition_id",), "class": ("class_id",),
    "classroom": ("room_id",), "class_assignment": ("class_id", "room_id"), "activity": ("activity_id",),
    "degree_enrollment": ("student_id", "degree_id"), "course_enrollment": ("student_id", "edition_id"),
    "activity_participation": ("student_id", "activity_id"),
    "instructor_assignment": ("instructor_id", "edition_id"),
    "course_prerequisites": ("course_code", "prerequisite_code"),
    "degree_courses": ("degree_id", "course_code"), "financial_transaction": ("transaction_id",),
    "student_class": ("student_id", "class_id"),
}


# Foreign keys of the DDL: (child table, child column, parent table, parent column).
FOREIGN_KEYS = (
    ("student", "user_id", "users", "user_id"),
    ("instructor", "user_id", "users", "user_id"),
    ("admin", "user_id", "users", "user_id"),
    ("academic_record", "student_id", "student", "user_id"),
    ("financial_account", "student_id", "student", "user_id"),
    ("course_edition", "course_code", "course", "code"),
    ("course_edition", "coordinator_id", "instructor", "user_id"),
    ("class", "edition_id", "course_edition", "edition_id"),
    ("class_assignment", "class_id", "class", "class_id"),
    ("class_assignment", "room_id", "classroom", "room_id"),
    ("degree_enrollment", "student_id", "student", "user_id"),
    ("degree_enrollment", "degree_id", "degree_program", "degree_id"),
    ("course_enrollment", "student_id", "student", "user_id"),
    ("course_enrollment", "edition_id", "course_edition", "edition_id"),
    ("activity_participation", "student_id", "student", "user_id"),
    ("activity_participation", "activity_id", "activity", "activity_id"),
    ("instructor_assignment", "instructor_id", "instructor", "user_id"),
    ("instructor_assignment", "edition_id", "course_edition", "edition_id"),
    ("course_prerequisites", "course_code", "course", "code"),
    ("course_prerequisites", "prerequisite_code", "course", "code"),
    ("degree_courses", "degree_id", "degree_program", "degree_id"),
    ("degree_courses", "course_code", "course", "code"),
    ("financial_transaction", "account_id", "financial_account", "account_id"),
    ("financial_transaction", "activity_id", "activity", "activity_id"),
    ("financial_transaction", "degree_id", "degree_program", "degree_id"),
    ("student_class", "student_id", "student", "user_id"),
    ("student_class", "class_id", "class", "class_id"),
)


def empty(spark, name: str):
    """An empty table with the declared schema (initial state of a derived table)."""
    schema = SCHEMAS.get(name) or REQUEST_SCHEMAS[name]
    return spark.createDataFrame([], schema)
