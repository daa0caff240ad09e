"""Validated table-scale writes: a request table in, one status per request and
the new table versions out (W08 registration, W09 insert-if-absent, W10 degree
enrolment, W11 tuition posting, W12 activity enrolment, W17 erasure).

Checks run in the reference's order; the first failing check names the reason.
In-batch conflicts are first-wins by ``seq``: the first valid request for a key
is found with a grouped ``min(seq)`` (partial aggregation, so a hot key costs one
row per map task) and joined back on (key, seq), a unique pair, so no join
partition holds a hot key. New ids continue the table's largest id in
request order (``dense_ids``), never through a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.functions.columns import first_reason, nonblank, to_money
from registrar.functions.sequence import dense_ids, materialize
from registrar.operators.admission import Outcome
from registrar.operators.reports import tbl
from registrar.schema import FOREIGN_KEYS, PRIMARY_KEYS
from registrar.sources.versions import StoredTable


def _max_id(df: DataFrame, col: str):
    """Largest id of a table as a scalar subquery (0 for an empty table)."""
    return df.select(F.coalesce(F.max(col), F.lit(0)).cast("long")).scalar()


def _first_valid(df: DataFrame, keys: Sequence[str], valid, order: str = "seq") -> DataFrame:
    """Add ``is_first`` = this row is the earliest ``valid`` row of its key.

    The earliest ``order`` per key is a grouped ``min`` (partial aggregation, so a
    hot key costs one row per map task); it is joined back on (key, order), which is
    unique per row, so a key holding a third of the requests is not one partition
    of the join."""
    firsts = (df.where(valid).groupBy(*keys).agg(F.min(order).alias(order))
                .withColumn("is_first", F.lit(True)))
    j = df.join(firsts, [*keys, order], "left")
    return j.withColumn("is_first", F.coalesce(F.col("is_first"), F.lit(False)))


def _marker(df: DataFrame, name: str) -> DataFrame:
    return df.distinct().withColumn(name, F.lit(True))


# ------------------------------------------------------------------ W08 registration

def register_users(T, requests: DataFrame, role: str = "student") -> Outcome:
    """Register users of one role. Username, email and password must be present;
    the username must be new to the table and to earlier requests of the batch.
    Writes a ``users`` row and the subtype row (``student`` / ``instructor``
    with ``is_coordinator`` default false / ``admin``)."""
    users = tbl(T, "users")
    fields_ok = nonblank("username") & nonblank("email") & F.coalesce(F.col("password_present"), F.lit(False))
    r = requests.withColumn("fields_ok", fields_ok)
    r = r.join(_marker(users.select("username"), "_exists"), "username", "left")
    r = r.withColumn("exists", F.coalesce("_exists", F.lit(False)))
    r = _first_valid(r, ["username"], F.col("fields_ok") & ~F.col("exists"))
    status = first_reason((F.col("fields_ok"), "missing_fields"), (~F.col("exists"), "username_exists"),
                          (F.col("is_first"), "duplicate_in_batch"))
    r = r.withColumn("status", status)
    ok = dense_ids(r.where(F.col("status") == "ok"), ["seq"], "user_id", start=_max_id(users, "user_id"))
    outcome = (r.join(ok.select("seq", "user_id"), "seq", "left")
                .select("seq", "username", "status", "user_id"))
    new_users = ok.select("user_id", "username", "email", F.lit(role).alias("role"))
    tables = {"users": users.unionByName(new_users)}
    if role == "student":
        sub = ok.select("user_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("date").alias("birth_date"),
                        F.lit(None).cast("string").alias("address"), F.lit(None).cast("string").alias("district"))
        tables["student"] = tbl(T, "student").unionByName(sub)
    elif role == "instructor":
        sub = ok.select("user_id", F.coalesce("is_coordinator", F.lit(False)).alias("is_coordinator"))
        tables["instructor"] = tbl(T, "instructor").unionByName(sub)
    elif role == "admin":
        tables["admin"] = tbl(T, "admin").unionByName(ok.select("user_id"))
    else:
        raise ValueError(f"unknown role {role!r}")
    return Outcome(outcome, tables)


# ------------------------------------------------------------------ W09 insert-if-absent

def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: str = "seq",
                     id_col: str | None = None) -> Outcome:
    """``INSERT ... ON CONFLICT DO NOTHING``: the first row of each key (by ``order``) is
    kept, keys already in the target are skipped, and a row with a null in its key isn't
    inserted. The outcome has a status per row: ``ok``, ``null_key``, ``exists`` or
    ``duplicate_in_batch``; ``tables["target"]`` is the new table. With ``id_col`` the
    inserted rows get ids after the table's largest."""
    keys = list(keys)
    r = rows.join(_marker(target.select(*keys), "_there"), keys, "left")
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    r = r.withColumn("has_key", has_key).withColumn("there", F.coalesce("_there", F.lit(False)))
    r = _first_valid(r, keys, F.col("has_key") & ~F.col("there"), order)
    status = first_reason((F.col("has_key"), "null_key"), (~F.col("there"), "exists"), (F.col("is_first"), "duplicate_in_batch"))
    r = r.withColumn("status", status)
    new = r.where(F.col("status") == "ok")
    if id_col:
        new = dense_ids(new, [order], id_col, start=_max_id(target, id_col))
    return Outcome(r.select(order, *[k for k in keys if k != order], "status"),
                   {"target": target.unionByName(new.select(*target.columns))})


# ------------------------------------------------------------------ W10 / W11 degree enrolment and tuition

def _fees(enrollments: DataFrame, degrees: DataFrame, as_of):
    """Fees to add per student, and the time of the change."""
    add = (enrollments.select("student_id", "degree_id")
           .join(degrees.select("degree_id", "tuition_fee"), "degree_id")
           .groupBy("student_id").agg(F.sum("tuition_fee").alias("__add")))
    return add, F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.lit(None).cast("timestamp_ntz")


def _opened(accounts: DataFrame, add: DataFrame, stamp) -> DataFrame:
    """New accounts of the students without one (ids after the largest, by student)."""
    opened = add.join(accounts.select("student_id").distinct(), "student_id", "left_anti")
    opened = dense_ids(opened, ["student_id"], "account_id", start=_max_id(accounts, "account_id"))
    return opened.select("account_id", "student_id", to_money("__add").alias("balance"), stamp.alias("last_update"))


def post_tuition(accounts: DataFrame, enrollments: DataFrame, degrees: DataFrame, as_of=None) -> DataFrame:
    """Each new degree enrolment adds its degree's fee to the student's balance; a
    student without an account gets one (ids after the largest, by student)."""
    add, stamp = _fees(enrollments, degrees, as_of)
    old = accounts.join(add, "student_id", "left").select(
        "account_id", "student_id", to_money(F.col("balance") + F.coalesce("__add", F.lit(0))).alias("balance"),
        F.when(F.col("__add").isNotNull(), stamp).otherwise(F.col("last_update")).alias("last_update"))
    return old.unionByName(_opened(accounts, add, stamp))


def tuition_changes(accounts: DataFrame, enrollments: DataFrame, degrees: DataFrame, as_of=None) -> DataFrame:
    """Only the accounts that :func:`post_tuition` changes or opens, for a stored table."""
    add, stamp = _fees(enrollments, degrees, as_of)
    add = materialize(add)  # read for the changed and for the new accounts
    changed = accounts.join(add, "student_id").select(
        "account_id", "student_id", to_money(F.col("balance") + F.col("__add")).alias("balance"), stamp.alias("last_update"))
    return changed.unionByName(_opened(accounts, add, stamp))


def enroll_degree(T, requests: DataFrame, as_of=None) -> Outcome:
    """Degree enrolment (student_id, degree_id, date): fields present -> student
    exists -> degree exists -> not already enrolled (table or earlier request).
    Accepted rows are added and their tuition posted (W11)."""
    st = _marker(tbl(T, "student").select(F.col("user_id").alias("student_id")), "_st")
    dp = _marker(tbl(T, "degree_program").select("degree_id"), "_dp")
    de = _marker(tbl(T, "degree_enrollment").select("student_id", "degree_id"), "_de")
    r = (requests.join(st, "student_id", "left").join(dp, "degree_id", "left")
                 .join(de, ["student_id", "degree_id"], "left"))
    fields = F.col("student_id").isNotNull() & F.col("date").isNotNull() & F.col("degree_id").isNotNull()
    r = r.select("seq", "student_id", "degree_id", "date", fields.alias("fields_ok"),
                 F.coalesce("_st", F.lit(False)).alias("student_ok"), F.coalesce("_dp", F.lit(False)).alias("degree_ok"),
                 (~F.coalesce("_de", F.lit(False))).alias("new_ok"))
    valid = F.col("fields_ok") & F.col("student_ok") & F.col("degree_ok") & F.col("new_ok")
    r = _first_valid(r, ["student_id", "degree_id"], valid)
    status = first_reason((F.col("fields_ok"), "missing_fields"), (F.col("student_ok"), "no_student"),
                          (F.col("degree_ok"), "no_degree"), (F.col("new_ok"), "already_enrolled"),
                          (F.col("is_first"), "already_enrolled"))
    outcome = r.select("seq", "student_id", "degree_id", status.alias("status"), "date")
    ok = outcome.where(F.col("status") == "ok").select("student_id", "degree_id", F.col("date").alias("enrollment_date"))
    tables = {
        "degree_enrollment": tbl(T, "degree_enrollment").unionByName(ok),
        "financial_account": post_tuition(tbl(T, "financial_account"), ok, tbl(T, "degree_program"), as_of),
    }
    return Outcome(outcome.drop("date"), tables)


# ------------------------------------------------------------------ W12 activity enrolment

def enroll_activity(T, requests: DataFrame, as_of) -> Outcome:
    """Activity enrolment (student_id, activity_id): activity exists -> not already
    enrolled (table or earlier request) -> student exists (the insert fails else). The fee is added to the student's
    existing account(s) only; ``fee_posted`` is false when there is none."""
    ac = tbl(T, "activity").select("activity_id", "fee", F.lit(True).alias("_ac"))
    ap = _marker(tbl(T, "activity_participation").select("student_id", "activity_id"), "_ap")
    accounts = tbl(T, "financial_account")
    has_acc = _marker(accounts.select("student_id"), "_acc")
    st = _marker(tbl(T, "student").select(F.col("user_id").alias("student_id")), "_st")
    r = (requests.join(ac, "activity_id", "left").join(ap, ["student_id", "activity_id"], "left")
                 .join(has_acc, "student_id", "left").join(st, "student_id", "left"))
    r = r.select("seq", "student_id", "activity_id", "fee", F.coalesce("_ac", F.lit(False)).alias("activity_ok"),
                 F.coalesce("_st", F.lit(False)).alias("student_ok"),
                 (~F.coalesce("_ap", F.lit(False))).alias("new_ok"), F.coalesce("_acc", F.lit(False)).alias("has_account"))
    r = _first_valid(r, ["student_id", "activity_id"], F.col("activity_ok") & F.col("new_ok") & F.col("student_ok"))
    status = first_reason((F.col("activity_ok"), "no_activity"), (F.col("new_ok"), "already_enrolled"),
                          (F.col("student_ok"), "no_student"), (F.col("is_first"), "already_enrolled"))
    r = r.withColumn("status", status)
    outcome = r.select("seq", "student_id", "activity_id", "status",
                       F.when(F.col("status") == "ok", F.col("has_account")).alias("fee_posted"))
    ok = r.where(F.col("status") == "ok")
    fees = ok.groupBy("student_id").agg(F.sum("fee").alias("__fee"))
    stamp = F.lit(as_of).cast("timestamp_ntz")
    new_acc = accounts.join(fees, "student_id", "left").select(
        "account_id", "student_id", to_money(F.col("balance") + F.coalesce("__fee", F.lit(0))).alias("balance"),
        F.when(F.col("__fee").isNotNull(), stamp).otherwise(F.col("last_update")).alias("last_update"))
    new_ap = ok.select("student_id", "activity_id", F.lit(as_of).cast("date").alias("registration_date"))
    tables = {"activity_participation": tbl(T, "activity_participation").unionByName(new_ap),
              "financial_account": new_acc}
    return Outcome(outcome, tables)


# ------------------------------------------------------------------ W17 erasure

def student_tables() -> list[tuple[str, str]]:
    """The tables that hold a student's rows and the column that says whose: those whose
    foreign key leads to a student, the ledger of the students' accounts, and the users."""
    own = {child: col for child, col, parent, _ in FOREIGN_KEYS if parent == "student"}
    ledger = {child: col for child, col, parent, _ in FOREIGN_KEYS if parent in own and col == "account_id"}
    return sorted({**own, **ledger, "student": "user_id", "users": "user_id"}.items())


def erase_students(T, requests: DataFrame) -> Outcome:
    """Delete every row of the requested students (ids must be users with role
    student; others are refused). The ledger rows of their accounts go too."""
    students = tbl(T, "users").where(F.col("role") == "student").select(F.col("user_id").alias("student_id"))
    req = requests.select("seq", "student_id")
    valid = materialize(req.join(students, "student_id", "left_semi").select("student_id").distinct())  # read by every table
    tables: dict[str, DataFrame] = {}
    for name, key in student_tables():
        gone = valid
        if key == "account_id":
            gone = tbl(T, "financial_account").join(valid, "student_id", "left_semi").select("account_id").distinct()
        tables[name] = tbl(T, name).join(gone.toDF(key), key, "left_anti")
    outcome = req.join(_marker(valid, "_ok"), "student_id", "left").select(
        "seq", "student_id", F.when(F.col("_ok"), F.lit("ok")).otherwise(F.lit("not_student")).alias("status"))
    return Outcome(outcome, tables)


def store_student_tables(T, root: str, buckets: int) -> dict[str, StoredTable]:
    """The tables that an erasure writes, stored in buckets by the column that says whose row it is."""
    return {name: StoredTable.create(tbl(T, name), f"{root}/{name}", PRIMARY_KEYS[name], _bucketed_by(name, key), buckets)
            for name, key in student_tables()}


def _bucketed_by(name: str, key: str) -> list[str]:
    return [key] if key in PRIMARY_KEYS[name] else list(PRIMARY_KEYS[name])


def erase_stored(stored: dict[str, StoredTable], requests: DataFrame) -> Outcome:
    """:func:`erase_students` on stored tables: rows go by key, in new versions that rewrite only the
    buckets touched, tables that refer to others first. The versions written are read again
    along the foreign keys; table ``confirmation`` says for each table how many rows it has
    and how many are left that name an erased student or account (``residual``)."""
    req = requests.select("seq", "student_id")
    students = stored["users"].read().where(F.col("role") == "student").select(F.col("user_id").alias("student_id"))
    valid = materialize(req.join(students, "student_id", "left_semi").select("student_id").distinct())
    accounts = materialize(stored["financial_account"].read().join(valid, "student_id", "left_semi").select("account_id").distinct())
    gone = {name: (accounts if key == "account_id" else valid).toDF(key) for name, key in student_tables()}
    for name, key in sorted(student_tables(), key=lambda t: _depth(t[0]), reverse=True):
        stored[name].delete_by(key, gone[name])
    confirmation = None
    for name, key in student_tables():
        left = stored[name].read()
        marks = left.join(_marker(gone[name], "__gone"), key, "left")
        row = marks.agg(F.count("*").alias("n_rows"), F.count("__gone").alias("residual")).select(F.lit(name).alias("table_name"), "n_rows", "residual")
        confirmation = row if confirmation is None else confirmation.unionByName(row)
    outcome = req.join(_marker(valid, "_ok"), "student_id", "left").select(
        "seq", "student_id", F.when(F.col("_ok"), F.lit("ok")).otherwise(F.lit("not_student")).alias("status"))
    return Outcome(outcome, {name: stored[name].read() for name, _ in student_tables()} | {"confirmation": confirmation})


def _depth(name: str) -> int:
    """How many foreign keys lead from a table up to one without any of the student tables above it."""
    above = {parent for child, _, parent, _ in FOREIGN_KEYS if child == name and parent in dict(student_tables())}
    return 1 + max(map(_depth, above)) if above else 0
