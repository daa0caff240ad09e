"""W13 admission to offerings and W14 class assignment, as one set-based plan.

The reference admits one request at a time: class list empty -> offering exists
-> full -> already enrolled -> prerequisites -> insert (which fails for a
student who doesn't exist) -> each class belongs to the offering (a failed class check
rolls the whole request back). Here the whole
request table is decided at once, deterministic by arrival order ``seq``:

    base        = has_classes ∧ offering_exists ∧ ¬enrolled ∧ prereq_ok ∧ student_exists ∧ classes_ok
    prior_base  = earlier base requests, same (offering, student)
    claim       = base ∧ prior_base = 0
    prior_claim = earlier claims, same offering
    status      = no_classes | no_edition
                | full      if enrolled_now + prior_claim >= capacity
                | duplicate if enrolled ∨ prior_base > 0
                | prereq | no_student | class | ok

A claim rejected as full never frees a seat later (counts only grow), so counting
every earlier claim equals counting the accepted ones. The two running counts use
``running_count`` (chunked), so an offering that receives a third of all requests
is still spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.functions.columns import first_reason
from registrar.functions.sequence import materialize, running_count
from registrar.operators.reports import missing_prerequisites, tbl

STATUSES = ("ok", "no_classes", "no_edition", "full", "duplicate", "prereq", "no_student", "class")


@dataclass
class Outcome:
    """Result of a validated write: one status row per request and the new tables."""
    outcome: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def accepted(self) -> DataFrame:
        return self.outcome.where(F.col("status") == "ok")

    @property
    def rejected(self) -> DataFrame:
        return self.outcome.where(F.col("status") != "ok")


def class_check(T, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Explode each request's class ids and check each belongs to the requested
    offering. Returns (per-request ``classes_ok``, the (seq, student_id, class_id) pairs)."""
    ex = requests.select("seq", "student_id", "edition_id", F.explode("classes").alias("class_id"))
    cl = tbl(T, "class").select("class_id", F.col("edition_id").alias("class_edition"), F.lit(True).alias("_hit"))
    j = ex.join(cl, (ex.class_id == cl.class_id) & (ex.edition_id == cl.class_edition), "left").select(
        ex.seq, ex.student_id, ex.class_id, F.coalesce(F.col("_hit"), F.lit(False)).alias("belongs"))
    j = materialize(j)  # read for the check and for the pairs
    ok = j.groupBy("seq").agg(F.bool_and("belongs").alias("classes_ok"))
    return ok, j.select("seq", "student_id", "class_id")


def assign_classes(T, requests: DataFrame) -> DataFrame:
    """W14 on its own: (student_id, class_id) for every request whose classes all
    belong to its offering (distinct pairs)."""
    ok, pairs = class_check(T, requests)
    good = ok.where("classes_ok").select("seq")
    return pairs.join(good, "seq", "left_semi").select("student_id", "class_id").distinct()


def decide(T, requests: DataFrame, taken: DataFrame, enrolled: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The decisions of W13 when ``taken`` (edition_id, n) seats are taken and ``enrolled``
    (student_id, edition_id) pairs exist, both before the first request; of offerings and
    pairs that no request names they need hold nothing. Returns the status per request and the
    (seq, student_id, class_id) pairs of all requests."""
    req = requests.select("seq", "student_id", "edition_id", "classes")
    ed = tbl(T, "course_edition").select("edition_id", "course_code", "capacity")
    co = tbl(T, "course").select(F.col("code").alias("course_code"))
    current = taken.select("edition_id", F.col("n").alias("_current"))
    # everything known per offering in one table (one join with the requests)
    offering = ed.join(co, "course_code").join(current, "edition_id", "left").withColumn("_exists", F.lit(True))
    # the enrolments asked for, before they are made distinct: few among all
    enrolled = enrolled.select("student_id", "edition_id").join(req.select("student_id", "edition_id"), ["student_id", "edition_id"], "left_semi")
    enrolled = enrolled.distinct().withColumn("_enrolled", F.lit(True))
    known = tbl(T, "student").select(F.col("user_id").alias("student_id")).distinct().withColumn("_student", F.lit(True))

    pairs = req.join(offering.select("edition_id", "course_code"), "edition_id").select("student_id", "course_code")
    gaps = missing_prerequisites(T, pairs).select("student_id", "course_code", "missing_count")
    cls_ok, cls_pairs = class_check(T, req)

    r = (req.join(offering, "edition_id", "left")
            .join(enrolled, ["student_id", "edition_id"], "left")
            .join(gaps, ["student_id", "course_code"], "left")
            .join(known, "student_id", "left")
            .join(cls_ok, "seq", "left"))
    has_classes = F.coalesce(F.size("classes") > 0, F.lit(False))
    exists = F.coalesce("_exists", F.lit(False))
    is_enrolled = F.coalesce("_enrolled", F.lit(False))
    prereq_ok = F.coalesce(F.col("missing_count") == 0, F.lit(True))
    student_ok = F.coalesce("_student", F.lit(False))
    classes_ok = F.coalesce("classes_ok", F.lit(False))
    r = r.select("seq", "student_id", "edition_id", "capacity",
                 F.coalesce("_current", F.lit(0)).alias("current"),
                 has_classes.alias("has_classes"), exists.alias("exists"), is_enrolled.alias("enrolled"),
                 prereq_ok.alias("prereq_ok"), student_ok.alias("student_ok"), classes_ok.alias("classes_ok"))
    base = F.col("has_classes") & F.col("exists") & ~F.col("enrolled") & F.col("prereq_ok") & F.col("student_ok") & F.col("classes_ok")
    kw = {"parts": parts} if parts else {}
    r = running_count(r.withColumn("base", base), ["edition_id", "student_id"], ["seq"], "base", "prior_base", **kw)
    r = r.withColumn("claim", F.col("base") & (F.col("prior_base") == 0))
    r = running_count(r, ["edition_id"], ["seq"], "claim", "prior_claim", **kw)
    status = first_reason(
        (F.col("has_classes"), "no_classes"),
        (F.col("exists"), "no_edition"),
        (F.col("current") + F.col("prior_claim") < F.col("capacity"), "full"),
        (~F.col("enrolled") & (F.col("prior_base") == 0), "duplicate"),
        (F.col("prereq_ok"), "prereq"),
        (F.col("student_ok"), "no_student"),
        (F.col("classes_ok"), "class"),
    )
    return r.select("seq", "student_id", "edition_id", status.alias("status")), cls_pairs


def admit_to_offering(T, requests: DataFrame, parts: int | None = None) -> Outcome:
    """Decide every admission request (seq, student_id, edition_id, classes).

    Returns the status per request, the new ``course_enrollment`` (accepted rows
    added with no grade) and the new ``student_class``.
    """
    ce = tbl(T, "course_enrollment")
    outcome, cls_pairs = decide(T, requests, ce.groupBy("edition_id").agg(F.count("*").alias("n")), ce, parts)
    ok = outcome.where(F.col("status") == "ok")
    new_enrol = ok.select("student_id", "edition_id", F.lit(None).cast(ce.schema["grade"].dataType).alias("grade"),
                          F.lit(None).cast("long").alias("attendance"),
                          F.lit(None).cast("string").alias("evaluation_period"))
    if "year" in ce.columns:  # stored layout: new rows carry their offering's year
        new_enrol = new_enrol.join(tbl(T, "course_edition").select("edition_id", "year"), "edition_id", "left")
    # stored, so that its size is known before the whole table of classes is dealt for it
    new_classes = materialize(cls_pairs.join(ok.select("seq"), "seq", "left_semi").select("student_id", "class_id").distinct())
    sc = tbl(T, "student_class")
    there = sc.join(new_classes, ["student_id", "class_id"], "left_semi")
    tables = {
        "course_enrollment": ce.unionByName(new_enrol),
        "student_class": sc.unionByName(new_classes.join(there, ["student_id", "class_id"], "left_anti")),
    }
    return Outcome(outcome, tables)
