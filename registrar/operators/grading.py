"""W15 grade submission in batches and W16 the academic-record rule.

Batches arrive flat: a header table ``(batch_id, edition_id, submitter_id, period)``
and a row table ``(batch_id, pos, pair)`` where ``pair`` is the submitted
``[student, grade]`` entry. (``split_batches`` turns nested request bodies into
this form with ``posexplode``.) A batch never has to fit in one row or one task.

Per batch, in the reference's order: period and grades present (and all parts, where it came in
parts) -> offering
exists -> submitter is its coordinator -> for each well-formed pair by position:
0 <= grade <= 20 (raw value; null/NaN fail) -> student enrolled. The first
failure rejects the whole batch (reported with its position). Entries that are
not pairs are skipped. Accepted grades are stored as NUMERIC(5,2) (half-up), the
last write per (student, offering) winning in (batch_id, pos) order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.functions.columns import cents, first_reason, passed, rounded_mean_from_cents, to_grade, valid_grade
from registrar.functions.sequence import dense_ids, materialize
from registrar.operators.admission import Outcome
from registrar.operators.reports import tbl
from registrar.schema import GRADE_TYPE

BATCH_STATUSES = ("ok", "missing_fields", "incomplete", "no_edition", "not_coordinator", "invalid_grade", "not_enrolled")


def split_batches(nested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested bodies ``(batch_id, edition_id, submitter_id, period, grades array<array<string>>)``
    -> (headers, rows) with ``pos`` = index in the list.

    With columns ``first`` and ``total`` a batch may come in several parts (null: the whole list).
    Parts are joined by (batch_id, first); one that was sent twice counts once, the header is
    that of the part that comes first in the list, and ``total`` goes into the header, so that
    ``submit_grades`` refuses a batch of which a part is missing (``incomplete``)."""
    if "first" not in nested.columns:
        headers = nested.select("batch_id", "edition_id", "submitter_id", "period")
        return headers, nested.select("batch_id", F.posexplode("grades").alias("pos", "pair")).withColumn("pos", F.col("pos").cast("long"))
    parts = nested.withColumn("first", F.coalesce("first", F.lit(0))).dropDuplicates(["batch_id", "first"])
    parts = materialize(parts)  # read for the headers and for the rows, each more than once
    head = F.min_by(F.struct("edition_id", "submitter_id", "period", "total"), F.col("first"))
    headers = parts.groupBy("batch_id").agg(head.alias("h")).select("batch_id", "h.*")
    rows = parts.select("batch_id", "first", F.posexplode("grades").alias("pos", "pair"))
    return headers, rows.select("batch_id", (F.col("first") + F.col("pos")).alias("pos"), "pair")


def _student_id(text) -> F.Column:
    """The id that a text says: a whole number in range, spaces around it and zeros after a point
    allowed, else null. A text that is its number's own spelling needs no pattern."""
    plain = text.try_cast("long")
    spelled = F.when(text.rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"), F.regexp_replace(text, r"\.0*\s*$", "").try_cast("long"))
    return F.when(plain.cast("string") == text, plain).otherwise(spelled)


def _check_rows(T, headers: DataFrame, rows: DataFrame) -> DataFrame:
    """Every well-formed row with its reason (``ok`` or the row-level failure), and a row without
    one and with ``empty`` for a header without rows, well-formed or not."""
    # an id that isn't a whole number in range is just not enrolled; a grade that isn't a
    # number is null and fails the range check
    well = F.coalesce(F.size("pair") == 2, F.lit(False))
    pair = [F.when(F.col("_well"), F.col("pair")[i]) for i in (0, 1)]
    r = rows.select("batch_id", "pos", "pair", well.alias("_well")).select(
        "batch_id", "pos", "_well", _student_id(pair[0]).alias("student_id"), pair[1].try_cast("double").alias("raw_grade"))
    r = headers.select("batch_id", "edition_id", "period").join(r, "batch_id", "left").where("_well is null or _well")
    enrolled = tbl(T, "course_enrollment").select("student_id", "edition_id").distinct().withColumn("_en", F.lit(True))
    r = r.join(enrolled, ["student_id", "edition_id"], "left")
    reason = first_reason((valid_grade("raw_grade"), "invalid_grade"), (F.coalesce("_en", F.lit(False)), "not_enrolled"))
    empty = F.col("_well").isNull()
    return r.select("batch_id", "pos", "student_id", "edition_id", "period", "raw_grade", empty.alias("empty"), F.when(~empty, reason).alias("reason"))


def submit_grades(T, headers: DataFrame, rows: DataFrame) -> Outcome:
    """Decide every batch; apply the accepted ones to ``course_enrollment``.

    Outcome: ``(batch_id, edition_id, status, bad_pos)``. Tables: the new
    ``course_enrollment``, ``grade_change`` — every applied row in (batch_id, pos) order (the
    updates the record trigger would see) — and ``grade_update``, the last of them per
    enrolment, as a change of a stored ``course_enrollment`` by key.
    """
    ed = tbl(T, "course_edition").select("edition_id", "coordinator_id", F.lit(True).alias("_ed"))
    checked = materialize(_check_rows(T, headers, rows))  # read for the first failure and for the accepted rows
    first_bad = (checked.where(F.col("empty") | (F.col("reason") != "ok")).groupBy(F.col("batch_id").alias("_batch"))
                        .agg(F.min_by(F.struct("reason", "pos"), F.col("pos")).alias("bad"), F.bool_or("empty").alias("_empty")))
    h = headers.join(ed, "edition_id", "left")
    whole = F.lit(True)
    if "total" in headers.columns:
        h = h.join(rows.groupBy("batch_id").agg(F.count("*").alias("_n")), "batch_id", "left")
        whole = F.coalesce(F.col("_n") == F.col("total"), F.lit(True))
    h = h.join(first_bad, F.col("batch_id").eqNullSafe(F.col("_batch")), "left")
    head_reason = first_reason(
        ((F.length(F.coalesce("period", F.lit(""))) > 0) & ~F.coalesce("_empty", F.lit(False)), "missing_fields"),
        (whole, "incomplete"),
        (F.coalesce("_ed", F.lit(False)), "no_edition"),
        (F.col("submitter_id") == F.col("coordinator_id"), "not_coordinator"))
    b = h.select("batch_id", "edition_id", head_reason.alias("head_reason"), "bad")
    status = (F.when(F.col("head_reason") != "ok", F.col("head_reason"))
               .when(F.col("bad").isNotNull(), F.col("bad.reason")).otherwise(F.lit("ok")))
    bad_pos = F.when((F.col("head_reason") == "ok") & F.col("bad").isNotNull(), F.col("bad.pos"))
    outcome = b.select("batch_id", "edition_id", status.alias("status"), bad_pos.alias("bad_pos"))

    applied = (checked.where(~F.col("empty")).join(outcome.where(F.col("status") == "ok").select("batch_id"), "batch_id", "left_semi")
                      .select("student_id", "edition_id", to_grade("raw_grade").alias("grade"), "period",
                              "batch_id", "pos"))
    latest = (applied.groupBy("student_id", "edition_id")
                     .agg(F.max_by(F.struct("grade", "period"), F.struct("batch_id", "pos")).alias("__l"))
                     .select("student_id", "edition_id", F.col("__l.grade").alias("__g"), F.col("__l.period").alias("__p"),
                             F.lit(True).alias("__hit")))
    ce = tbl(T, "course_enrollment")
    extra = [c for c in ce.columns if c not in ("student_id", "edition_id", "grade", "attendance", "evaluation_period")]
    new_ce = ce.join(latest, ["student_id", "edition_id"], "left").select(
        "student_id", "edition_id",
        F.when(F.col("__hit"), F.col("__g")).otherwise(F.col("grade")).cast(GRADE_TYPE).alias("grade"),
        "attendance",
        F.when(F.col("__hit"), F.col("__p")).otherwise(F.col("evaluation_period")).alias("evaluation_period"),
        *extra)
    changes = applied.select("student_id", "edition_id", "grade", "batch_id", "pos")
    update = latest.select("student_id", "edition_id", F.col("__g").alias("grade"), F.col("__p").alias("evaluation_period"))
    return Outcome(outcome, {"course_enrollment": new_ce, "grade_change": changes, "grade_update": update})


# ------------------------------------------------------------------ W16 academic record

def _record_degree(T) -> DataFrame:
    """The degree a new record is opened with: the student's lowest degree id."""
    de = tbl(T, "degree_enrollment")
    return de.groupBy("student_id").agg(F.min_by(F.struct("degree_id", "enrollment_date"), F.col("degree_id")).alias("d")) \
             .select("student_id", F.col("d.degree_id").alias("degree_id"), F.col("d.enrollment_date").alias("enrollment_date"))


def _finish_records(T, per_student: DataFrame, opened_by: str) -> DataFrame:
    """Keep existing record ids and open records (ids after the largest): the trigger
    (``inner``) opens one only for a student with a degree enrolment, a recompute (``left``)
    for every student with a pass."""
    old = tbl(T, "academic_record")
    per_student = materialize(per_student)  # read by three branches below
    kept = per_student.join(old.select("record_id", "student_id", "current_semester", "degree_id", "enrollment_date"),
                            "student_id")
    fresh = (per_student.join(old.select("student_id"), "student_id", "left_anti")
                        .join(_record_degree(T), "student_id", opened_by))
    fresh = dense_ids(fresh, ["student_id"], "record_id",
                      start=old.select(F.coalesce(F.max("record_id"), F.lit(0)).cast("long")).scalar())
    cols = ["record_id", "student_id", "average", "approved_courses", "current_semester", "degree_id", "enrollment_date"]
    fresh = fresh.withColumn("current_semester", F.lit(None).cast("long"))
    untouched = old.join(per_student.select("student_id"), "student_id", "left_anti")
    return kept.select(*cols).unionByName(fresh.select(*cols)).unionByName(untouched.select(*cols))


def refresh_academic_record(T, mode: str = "recompute", changes: DataFrame | None = None,
                            before: DataFrame | None = None) -> DataFrame:
    """Academic record per student.

    ``recompute`` (right): approved_courses = passing enrolments, average = their
    mean (2 decimals, exact) from the current ``course_enrollment``. A record whose
    student has no pass left gets 0 courses and no average.
    ``replay`` reproduces the row trigger over the update log ``changes``
    (student_id, edition_id, grade, batch_id, pos) applied to the grades
    ``before`` the updates: each passing update adds 1 to the counter (a regrade
    counts again; a drop below the pass mark changes nothing) and sets the
    average of all passing grades at that moment.
    """
    if mode == "recompute":
        ce = tbl(T, "course_enrollment").where(passed("grade"))
        per = ce.groupBy("student_id").agg(F.sum(cents("grade")).alias("s"), F.count("grade").alias("n"))
        per = per.select("student_id", rounded_mean_from_cents("s", "n").cast(GRADE_TYPE).alias("average"),
                         F.col("n").cast("long").alias("approved_courses"))
        none = tbl(T, "academic_record").select("student_id").join(per.select("student_id"), "student_id", "left_anti")
        none = none.select("student_id", F.lit(None).cast(GRADE_TYPE).alias("average"), F.lit(0).cast("long").alias("approved_courses"))
        return _finish_records(T, per.unionByName(none), "left")
    if mode != "replay":
        raise ValueError(mode)
    assert changes is not None and before is not None
    order = F.struct("batch_id", "pos")
    hits = changes.where(passed("grade")).groupBy("student_id").agg(F.max(order).alias("__last"), F.count("*").alias("__k"))
    # the average is taken at the student's last passing update: the steps of an enrolment up to
    # there add up to its grade then less its grade before, so no row needs the one before it
    then = (changes.join(hits.select("student_id", "__last"), "student_id").where(order <= F.col("__last"))
                   .groupBy("student_id", "edition_id").agg(F.max_by("grade", order).alias("grade")))
    moved = signed_deltas(before, then).groupBy("student_id").agg(F.sum("d_cents").alias("__ds"), F.sum("d_count").alias("__dn"))
    base = passing_sums(before)
    old = tbl(T, "academic_record").select("student_id", F.col("approved_courses").alias("__a0"))
    per = hits.join(moved, "student_id", "left").join(base, "student_id", "left").join(old, "student_id", "left")
    s = F.coalesce("cents", F.lit(0)) + F.coalesce("__ds", F.lit(0))
    n = F.coalesce("n", F.lit(0)) + F.coalesce("__dn", F.lit(0))
    per = per.select("student_id", rounded_mean_from_cents(s, n).cast(GRADE_TYPE).alias("average"),
                     (F.coalesce("__a0", F.lit(0)) + F.col("__k")).cast("long").alias("approved_courses"))
    return _finish_records(T, per, "inner")


# ------------------------------------------------------------------ W16 kept up by signed deltas

def passing_sums(enrollments: DataFrame) -> DataFrame:
    """State of the record rule: student_id, cents (of the passing grades), n (passes)."""
    passes = enrollments.where(passed("grade"))
    return passes.groupBy("student_id").agg(F.sum(cents("grade")).alias("cents"), F.count("*").alias("n"))


def signed_deltas(before: DataFrame, updates: DataFrame) -> DataFrame:
    """What each update (student_id, edition_id, grade; one per enrolment) adds to its student's
    cents and passes and what the grade ``before`` it takes away: student_id, edition_id,
    d_cents, d_count. Only the enrolments that are updated are looked up."""
    was = before.select("student_id", "edition_id", F.col("grade").alias("was"))
    return deltas_of(updates.select("student_id", "edition_id", "grade").join(was, ["student_id", "edition_id"], "left"))


def deltas_of(both: DataFrame) -> DataFrame:
    """``signed_deltas`` of rows that have the new ``grade`` beside the one that there ``was``."""
    worth = lambda g: F.when(passed(g), cents(g)).otherwise(F.lit(0))
    count = lambda g: F.when(passed(g), F.lit(1)).otherwise(F.lit(0))
    return both.select("student_id", "edition_id", (worth("grade") - worth("was")).alias("d_cents"),
                       (count("grade") - count("was")).cast("long").alias("d_count"))


def added_sums(sums: DataFrame, deltas: DataFrame) -> DataFrame:
    """The state of the students that ``deltas`` name, after them."""
    moved = deltas.groupBy("student_id").agg(F.sum("d_cents").alias("__dc"), F.sum("d_count").alias("__dn"))
    return moved.join(sums, "student_id", "left").select(
        "student_id", (F.coalesce("cents", F.lit(0)) + F.col("__dc")).alias("cents"), (F.coalesce("n", F.lit(0)) + F.col("__dn")).alias("n"))


def apply_grade_updates(T, sums: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records and the state after ``updates`` to the grades in ``T``'s enrolments, from the
    state ``sums`` that belongs to them: the updated enrolments are looked up, no other grade is."""
    changed = materialize(added_sums(sums, signed_deltas(tbl(T, "course_enrollment"), updates)))
    state = sums.join(changed.select("student_id"), "student_id", "left_anti").unionByName(changed)
    records = tbl(T, "academic_record")
    per = state.where("n > 0").unionByName(  # a record without a pass left is emptied
        records.select("student_id").join(state.where("n > 0").select("student_id"), "student_id", "left_anti")
               .select("student_id", F.lit(0).cast("long").alias("cents"), F.lit(0).cast("long").alias("n")))
    per = per.select("student_id", rounded_mean_from_cents("cents", "n").cast(GRADE_TYPE).alias("average"), F.col("n").cast("long").alias("approved_courses"))
    return _finish_records(T, per, "left"), state
