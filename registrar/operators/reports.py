"""Read reports: transcript, offering statistics, rankings, period report,
prerequisite gaps and seat availability.

``T`` is any mapping-like object with the domain tables as attributes or keys
(``registrar.sources.fixtures.Campus`` or a plain dict).

Scale notes. Every report aggregates before it joins (the fact table is reduced
to one row per offering / student before meeting the dimensions), so no join
multiplies rows. Rankings use aggregations or ``rank``/``row_number`` filters that
Spark turns into a partial ``WindowGroupLimit`` ahead of the shuffle, so a hot
district or period sends only its leaders across the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar.functions.columns import avg_2dp, passed, rounded_mean_from_cents


def tbl(T, name: str) -> DataFrame:
    return T[name] if isinstance(T, dict) else getattr(T, name)


def _restrict(df: DataFrame, col: str, ids) -> DataFrame:
    """Keep rows whose ``col`` is in ``ids`` (a list, or a DataFrame with that column)."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(col)).distinct(), col, "left_semi")
    return df.where(F.col(col).isin(list(ids)))


# ------------------------------------------------------------------ W01 transcript

def transcript(T, student_ids=None) -> DataFrame:
    """Each enrolment of a student with offering year, course, grade, period,
    attendance and coordinator name (coordinator optional); newest first."""
    ce = _restrict(tbl(T, "course_enrollment"), "student_id", student_ids)
    ed = tbl(T, "course_edition").select("edition_id", "course_code", "year", "coordinator_id")
    co = tbl(T, "course").select(F.col("code").alias("course_code"), F.col("name").alias("course_name"))
    us = tbl(T, "users").select(F.col("user_id").alias("coordinator_id"), F.col("username").alias("coordinator_name"))
    # dimensions first (offering + course + coordinator name, one row per offering),
    # then one join of the enrolment facts on edition_id: no fact join on a
    # coordinator key, which one coordinator could dominate
    offering = ed.join(co, "course_code").join(us, "coordinator_id", "left")
    out = (ce.join(offering, "edition_id")
             .select("student_id", F.col("edition_id").alias("course_edition_id"), "course_name",
                     F.col("year").alias("course_edition_year"), F.col("grade").cast("double").alias("grade"),
                     "evaluation_period", "attendance", "course_code", "coordinator_id", "coordinator_name"))
    # a student's rows together and in order; students in no order, so no global sort
    return out.repartition("student_id").sortWithinPartitions(
        "student_id", F.col("course_edition_year").desc(), F.col("course_edition_id").desc())


# ------------------------------------------------------------------ W02 offering statistics

def _enrolment_counts(ce: DataFrame) -> DataFrame:
    return ce.groupBy("edition_id").agg(F.count("student_id").alias("n_enrolled"),
                                        F.count_if(passed("grade")).alias("n_passed"))


def _instructor_sets(ia: DataFrame) -> DataFrame:
    return ia.groupBy("edition_id").agg(F.array_sort(F.collect_set("instructor_id")).alias("instructors"),
                                        F.count("instructor_id").alias("n_instr"))


def offering_stats(T, degree_id=None, mode: str = "correct") -> DataFrame:
    """Per offering of a degree: capacity, enrolled, passed (grade >= 9.5) and the
    sorted instructor ids (empty array when none); offerings without enrolments kept.

    ``mode``: ``correct`` counts each enrolment once; ``fanout`` reproduces the
    reference's count after joining enrolments and instructors together (each
    count multiplied by the instructor count, at least 1) without materialising
    the product; ``nonempty`` is the older variant: every offering that has an
    enrolment, no degree filter, fan-out counts.
    With ``degree_id=None`` every degree is reported (a ``degree_id`` column).
    """
    ed = tbl(T, "course_edition").select("edition_id", "course_code", "year", "capacity", "coordinator_id")
    co = tbl(T, "course").select(F.col("code").alias("course_code"), F.col("name").alias("course_name"))
    base = ed.join(co, "course_code")
    if mode == "nonempty":
        base = base.join(tbl(T, "course_enrollment").select("edition_id"), "edition_id", "left_semi")
        base = base.withColumn("degree_id", F.lit(None).cast("long"))
    else:
        dc = tbl(T, "degree_courses")
        if degree_id is not None:
            dc = dc.where(F.col("degree_id") == F.lit(degree_id))
        base = base.join(dc.select("degree_id", "course_code"), "course_code")
    stats = (base.join(_enrolment_counts(tbl(T, "course_enrollment")), "edition_id", "left")
                 .join(_instructor_sets(tbl(T, "instructor_assignment")), "edition_id", "left"))
    n_enr = F.coalesce("n_enrolled", F.lit(0))
    n_pass = F.coalesce("n_passed", F.lit(0))
    if mode in ("fanout", "nonempty"):
        mult = F.greatest(F.coalesce("n_instr", F.lit(0)), F.lit(1))
        n_enr, n_pass = n_enr * mult, n_pass * mult
    out = stats.select("degree_id", F.col("course_code").alias("course_id"), "course_name",
                       F.col("edition_id").alias("course_edition_id"), F.col("year").alias("course_edition_year"),
                       "capacity", n_enr.cast("long").alias("enrolled_count"),
                       n_pass.cast("long").alias("approved_count"), "coordinator_id",
                       F.coalesce("instructors", F.array().cast("array<bigint>")).alias("instructors"))
    return out.orderBy(F.col("course_edition_year").desc(), "course_id", "degree_id", "course_edition_id")


# ------------------------------------------------------------------ W03 / W04 top-N and nesting

def student_averages(T, year=None) -> DataFrame:
    """Per student: average of non-null grades rounded to 2 decimals (exact), over one
    year when given. Joined to ``student`` (students without a row are left out)."""
    ce = tbl(T, "course_enrollment")
    if year is not None and "year" in ce.columns:
        ce = ce.where(F.col("year") == F.lit(year))   # stored layout: partition pruning
    ce = ce.select("student_id", "edition_id", "grade").where(F.col("grade").isNotNull())
    if year is not None:
        ed = tbl(T, "course_edition").select("edition_id", "year").where(F.col("year") == F.lit(year))
        ce = ce.join(ed.select("edition_id"), "edition_id")
    s, n = avg_2dp("grade")
    per = ce.groupBy("student_id").agg(s.alias("sum_cents"), n.alias("n_grades"))
    st = tbl(T, "student").select(F.col("user_id").alias("student_id"), F.col("name").alias("student_name"), "district")
    return (per.join(st, "student_id")
               .select("student_id", "student_name", "district",
                       rounded_mean_from_cents("sum_cents", "n_grades").alias("average_grade")))


def top_n_by_average(T, year=2024, n: int = 3) -> DataFrame:
    """Best ``n`` students by average grade in ``year``; ties broken by student id."""
    avgs = student_averages(T, year).select("student_id", "student_name", "average_grade")
    return avgs.orderBy(F.col("average_grade").desc(), "student_id").limit(n)


def nest_details(T, students: DataFrame, year) -> DataFrame:
    """For chosen students: ``grades`` = array of {course_edition_id, course_edition_name,
    grade, date} in ``year`` and ``activities`` = array of activity names; missing ->
    empty array. Arrays are sorted (JSON lists carry no order)."""
    ids = students.select("student_id").distinct()
    ce = tbl(T, "course_enrollment")
    if "year" in ce.columns:
        ce = ce.where(F.col("year") == F.lit(year))   # stored layout: partition pruning
    ce = ce.select("student_id", "edition_id", "grade").where(F.col("grade").isNotNull())
    ce = ce.join(ids, "student_id", "left_semi")
    ed = tbl(T, "course_edition").select("edition_id", "course_code", "year").where(F.col("year") == F.lit(year))
    co = tbl(T, "course").select(F.col("code").alias("course_code"), F.col("name").alias("course_name"))
    g = ce.join(ed, "edition_id").join(co, "course_code")
    item = F.struct(F.col("edition_id").alias("course_edition_id"),
                    F.concat(F.col("course_name"), F.lit(" - "), F.col("year").cast("string")).alias("course_edition_name"),
                    F.col("grade").cast("double").alias("grade"),
                    F.concat(F.col("year").cast("string"), F.lit("-01-01")).alias("date"))
    grades = g.groupBy("student_id").agg(F.array_sort(F.collect_list(item)).alias("grades"))
    ap = tbl(T, "activity_participation").select("student_id", "activity_id").join(ids, "student_id", "left_semi")
    ac = tbl(T, "activity").select("activity_id", F.col("name").alias("activity_name"))
    acts = ap.join(ac, "activity_id").groupBy("student_id").agg(F.array_sort(F.collect_list("activity_name")).alias("activities"))
    empty_grades = F.array().cast(grades.schema["grades"].dataType)
    return (students.join(grades, "student_id", "left").join(acts, "student_id", "left")
                    .withColumn("grades", F.coalesce("grades", empty_grades))
                    .withColumn("activities", F.coalesce("activities", F.array().cast("array<string>"))))


def top_n_details(T, year=2024, n: int = 3) -> DataFrame:
    """The reference's top-N report: pick the N students first, then nest their
    grades and activities (reduce before nesting)."""
    top = top_n_by_average(T, year, n)
    return nest_details(T, top, year).orderBy(F.col("average_grade").desc(), "student_id")


# ------------------------------------------------------------------ W05 best per group

def top_by_group(T, group_col: str = "district") -> DataFrame:
    """Best average per group over all years, ties kept; null groups and null grades
    excluded."""
    avgs = student_averages(T).where(F.col(group_col).isNotNull())
    w = Window.partitionBy(group_col).orderBy(F.col("average_grade").desc())
    ranked = avgs.withColumn("_rk", F.rank().over(w))
    return (ranked.where(F.col("_rk") == 1).select("student_id", group_col, "average_grade")
                  .orderBy(F.col("average_grade").desc(), group_col, "student_id"))


# ------------------------------------------------------------------ W06 / W07 period report

def evaluation_stats(T, as_of) -> DataFrame:
    """Per offering (labelled ``YEAR-01``): evaluated and passed counts, for offering
    years >= year(as_of) - 1. Offerings without an evaluated grade do not appear."""
    as_of_year = F.year(F.lit(as_of).cast("date"))
    ce = tbl(T, "course_enrollment")
    if "year" in ce.columns:
        ce = ce.where(F.col("year") >= as_of_year - 1)   # stored layout: partition pruning
    ce = ce.select("student_id", "edition_id", "grade").where(F.col("grade").isNotNull())
    ed = (tbl(T, "course_edition").select("edition_id", "course_code", "year")
              .where(F.col("year") >= as_of_year - 1))
    co = tbl(T, "course").select(F.col("code").alias("course_code"), F.col("name").alias("course_edition_name"))
    counts = ce.groupBy("edition_id").agg(F.count("student_id").alias("evaluated"),
                                          F.count_if(passed("grade")).alias("approved"))
    month = F.date_format(F.make_date(F.col("year").cast("int"), F.lit(1), F.lit(1)), "yyyy-MM")
    return (counts.join(ed, "edition_id").join(co, "course_code")
                  .select(month.alias("month"), F.col("edition_id").alias("course_edition_id"),
                          "course_edition_name", "approved", "evaluated"))


def best_per_period(stats: DataFrame) -> DataFrame:
    """One offering per period: most passed, ties to the smallest offering id;
    newest period first. A grouped ``max`` of (approved, -id) — partial aggregation."""
    best = stats.groupBy("month").agg(
        F.max(F.struct(F.col("approved"), (-F.col("course_edition_id")).alias("neg_id"),
                       F.col("course_edition_name"), F.col("evaluated"))).alias("b"))
    return (best.select("month", (-F.col("b.neg_id")).alias("course_edition_id"),
                        F.col("b.course_edition_name").alias("course_edition_name"),
                        F.col("b.approved").alias("approved"), F.col("b.evaluated").alias("evaluated"))
                .orderBy(F.col("month").desc()))


def roster(T, offerings: DataFrame) -> DataFrame:
    """The enrolments of chosen offerings (edition_id, year). In the stored layout the year is
    joined too: the scan of the enrolments takes the years of the offerings at run time
    (dynamic partition pruning), whatever they were chosen by."""
    ce = tbl(T, "course_enrollment")
    on = ["edition_id", "year"] if "year" in ce.columns else ["edition_id"]
    return ce.join(offerings.select(*on), on).select("edition_id", "student_id", "grade", "evaluation_period")


def best_offering(T, as_of) -> DataFrame:
    """Of the offerings that are best in their period (W07), the one with most passes, at least one,
    ties to the newer period: (edition_id, year, approved)."""
    best = best_per_period(evaluation_stats(T, as_of)).where(F.col("approved") > 0)
    top = best.orderBy(F.col("approved").desc(), F.col("month").desc()).limit(1)
    return top.select(F.col("course_edition_id").alias("edition_id"), F.substring("month", 1, 4).cast("long").alias("year"), "approved")


# ------------------------------------------------------------------ W18 / W19 admission inputs

def passed_courses(T, courses: DataFrame | None = None) -> DataFrame:
    """Distinct (student_id, course_code) with a passing grade, of the given courses
    (column course_code) or of all."""
    ce = tbl(T, "course_enrollment").select("student_id", "edition_id", "grade").where(passed("grade"))
    ed = tbl(T, "course_edition").select("edition_id", "course_code")
    co = tbl(T, "course").select(F.col("code").alias("course_code"))
    if courses is not None:  # only these courses matter: reduce before the fact join
        co = co.join(courses, "course_code", "left_semi")
    return ce.join(ed.join(co, "course_code"), "edition_id").select("student_id", "course_code").distinct()


def missing_prerequisites(T, pairs: DataFrame) -> DataFrame:
    """For (student_id, course_code) pairs: prerequisite courses not yet passed, as a
    count and a sorted list (0 / empty when none)."""
    pairs = pairs.select("student_id", "course_code").distinct()
    pre = tbl(T, "course_prerequisites").select("course_code", "prerequisite_code")
    need = pairs.join(pre, "course_code")
    done = passed_courses(T, pre.select(F.col("prerequisite_code").alias("course_code")).distinct()).select("student_id", F.col("course_code").alias("prerequisite_code"))
    missing = need.join(done, ["student_id", "prerequisite_code"], "left_anti")
    agg = missing.groupBy("student_id", "course_code").agg(
        F.count("*").alias("missing_count"), F.array_sort(F.collect_list("prerequisite_code")).alias("missing"))
    return (pairs.join(agg, ["student_id", "course_code"], "left")
                 .select("student_id", "course_code", F.coalesce("missing_count", F.lit(0)).cast("long").alias("missing_count"),
                         F.coalesce("missing", F.array().cast("array<string>")).alias("missing")))


def seat_availability(T) -> DataFrame:
    """Per offering: capacity, enrolled, seats left (negative when over) and full flag."""
    ed = tbl(T, "course_edition").select("edition_id", "capacity")
    n = tbl(T, "course_enrollment").groupBy("edition_id").agg(F.count("*").alias("enrolled"))
    j = ed.join(n, "edition_id", "left").withColumn("enrolled", F.coalesce("enrolled", F.lit(0)).cast("long"))
    return j.select("edition_id", "capacity", "enrolled", (F.col("capacity") - F.col("enrolled")).alias("seats_left"),
                    (F.col("enrolled") >= F.col("capacity")).alias("is_full"))


def as_array_text(c: str) -> Column:
    """Sorted array as comma-joined text (for order-free comparison of nested output)."""
    return F.array_join(F.array_sort(F.col(c)).cast("array<string>"), ",")
