"""Degree programmes, refunds and the ledger: cancelled activities (P1), the ledger
with a running balance (P2), enrolments inside the student's programme (P3), progress
per degree (P4) and the most-passed courses of the last months (P5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.functions.columns import cents, first_reason, passed, to_money
from registrar.functions.sequence import running_sum
from registrar.operators.admission import Outcome
from registrar.operators.ingest import _first_valid, _marker
from registrar.operators.reports import passed_courses, tbl


def cancel_activities(T, requests: DataFrame, as_of) -> Outcome:
    """Cancellations (seq, student_id, activity_id), decided in order: the student must
    take part, and an earlier cancellation of the batch must not have ended that. An accepted
    one removes the participation, adds a negative charge of the fee, and gives the
    fee back to the student's account where there is one (``fee_refunded``)."""
    ap, accounts = tbl(T, "activity_participation"), tbl(T, "financial_account")
    r = (requests.join(_marker(ap.select("student_id", "activity_id"), "_in"), ["student_id", "activity_id"], "left")
                 .join(tbl(T, "activity").select("activity_id", "fee"), "activity_id", "left")
                 .join(_marker(accounts.select("student_id"), "_acc"), "student_id", "left"))
    r = r.withColumn("takes_part", F.coalesce("_in", F.lit(False)))
    r = _first_valid(r, ["student_id", "activity_id"], F.col("takes_part"))
    status = first_reason((F.col("takes_part"), "not_enrolled"), (F.col("is_first"), "already_cancelled"))
    r = r.withColumn("status", status)
    ok = r.where(F.col("status") == "ok")
    back = ok.groupBy("student_id").agg(F.sum("fee").alias("__back"))
    charges = ok.select("seq", "student_id", to_money(-F.col("fee")).alias("amount"), F.lit("cancellation").alias("kind"),
                        F.lit(as_of).cast("date").alias("charge_date"))
    balances = accounts.join(back, "student_id", "left").select(
        "account_id", "student_id", to_money(F.col("balance") - F.coalesce("__back", F.lit(0))).alias("balance"),
        F.when(F.col("__back").isNotNull(), F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col("last_update")).alias("last_update"))
    outcome = r.select("seq", "student_id", "activity_id", "status",
                       F.when(F.col("status") == "ok", F.coalesce("_acc", F.lit(False))).alias("fee_refunded"))
    return Outcome(outcome, {"activity_participation": ap.join(ok.select("student_id", "activity_id"), ["student_id", "activity_id"], "left_anti"),
                             "financial_account": balances, "refund": charges})


def charge_ledger(charges: DataFrame) -> DataFrame:
    """Every charge with the student's balance after it, in (date, id) order."""
    rows = charges.select("charge_id", "student_id", "kind", "amount", "charge_date")
    out = running_sum(rows, ["student_id"], ["charge_date", "charge_id"], cents("amount"), "__cents", inclusive=True)
    return out.select("charge_id", "student_id", "kind", "amount", "charge_date", to_money(F.col("__cents") / F.lit(100)).alias("balance_after"))


def program_restriction(T, pairs: DataFrame) -> DataFrame:
    """(student_id, edition_id) pairs with ``in_program``: the course belongs to a degree
    that the student is enrolled in."""
    ed = tbl(T, "course_edition").select("edition_id", "course_code")
    dc = tbl(T, "degree_courses").select("degree_id", "course_code")
    de = tbl(T, "degree_enrollment").select("student_id", "degree_id").distinct()
    asked = pairs.select("student_id", "edition_id").distinct().join(ed, "edition_id", "left")
    inside = asked.join(dc, "course_code").join(de, ["student_id", "degree_id"], "left_semi").select("student_id", "edition_id")
    return asked.join(_marker(inside, "_in"), ["student_id", "edition_id"], "left").select(
        "student_id", "edition_id", F.coalesce("_in", F.lit(False)).alias("in_program"))


def degree_progress(T) -> DataFrame:
    """Per degree enrolment: credits of the degree's courses the student has passed, and
    the credits of all its courses."""
    dc = tbl(T, "degree_courses").select("degree_id", "course_code").distinct()
    dc = dc.join(tbl(T, "course").select(F.col("code").alias("course_code"), "credits"), "course_code")
    required = dc.groupBy("degree_id").agg(F.sum("credits").alias("credits_required"))
    de = tbl(T, "degree_enrollment").select("student_id", "degree_id").distinct()
    got = (passed_courses(T).join(dc, "course_code").join(de, ["student_id", "degree_id"], "left_semi")
           .groupBy("student_id", "degree_id").agg(F.sum("credits").alias("got")))
    return (de.join(required, "degree_id", "left").join(got, ["student_id", "degree_id"], "left")
              .select("student_id", "degree_id", F.coalesce("got", F.lit(0)).cast("long").alias("credits_passed"),
                      F.coalesce("credits_required", F.lit(0)).cast("long").alias("credits_required")))


def most_passed(T, as_of, months: int = 12) -> DataFrame:
    """Courses by passes whose grade date (table ``grade_date``) lies in the ``months``
    before ``as_of``, that day included; most first, ties by code."""
    end = F.lit(as_of).cast("date")
    dates = tbl(T, "grade_date").where((F.col("graded_on") > F.add_months(end, -months)) & (F.col("graded_on") <= end))
    ce = tbl(T, "course_enrollment").select("student_id", "edition_id", "grade").where(passed("grade"))
    ed = tbl(T, "course_edition").select("edition_id", "course_code")
    n = ce.join(dates, ["student_id", "edition_id"]).groupBy("edition_id").agg(F.count("*").alias("n"))
    return (n.join(ed, "edition_id").groupBy("course_code").agg(F.sum("n").cast("long").alias("passed"))
             .orderBy(F.col("passed").desc(), "course_code"))
