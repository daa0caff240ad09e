"""W15 batch grading and W16 academic record (recompute, and replay against a
simulation of the row trigger)."""

import math
import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

from helpers import D, campus, df
from pyspark.sql import functions as F

from registrar.operators.grading import refresh_academic_record, split_batches, submit_grades

EDS = [(100, "EI", 2024, 50, None, 10), (101, "CD", 2024, 50, None, 11)]


def _enrol(spark):
    return campus(spark, course_edition=EDS,
                  course_enrollment=[(1, 100, None, None, None), (2, 100, D(5), None, None), (3, 101, None, None, None)],
                  degree_enrollment=[(1, 7, date(2024, 1, 1)), (2, 3, date(2024, 1, 1)), (2, 5, date(2024, 1, 1))])


def _nested(spark, rows):
    text = lambda v: str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
    rows = [(*r[:4], [[text(v) for v in pair] for pair in r[4]]) for r in rows]
    return spark.createDataFrame(rows, "batch_id long, edition_id long, submitter_id long, period string, "
                                       "grades array<array<string>>")


def test_batches_whole_rejection_first_position(spark):
    T = _enrol(spark)
    nested = _nested(spark, [
        (1, 100, 10, "Normal", [[1.0, 12.0], [2.0, 9.495], [1.0, 14.0, 0.0]]),      # ok; malformed skipped
        (2, 100, 10, "Recurso", [[1.0, 15.0], [2.0, 20.004], [9.0, 30.0]]),         # 20.004 > 20 at pos 1
        (3, 100, 11, "Normal", [[1.0, 10.0]]),                                    # not the coordinator
        (4, 101, 11, None, [[3.0, 10.0]]),                                        # no period
        (5, 555, 11, "Normal", [[3.0, 10.0]]),                                    # no such offering
        (6, 101, 11, "Normal", [[3.0, float("nan")]]),                             # NaN grade
        (7, 100, 10, "Normal", [[3.0, 10.0]]),                                    # not enrolled there
        (8, 101, 11, "Normal", [[3.0, 11.0], [3.0, 13.0]]),                        # last write wins
        (9, 101, 11, "Normal", [[1e30, 11.0]]),                                   # id out of range
        (10, 101, 11, "Normal", [[3.5, 11.0]]),                                   # not an integer id
        (11, 101, 11, "Normal", [[3, "x"]]),                                       # not a number
    ])
    headers, rows = split_batches(nested)
    res = submit_grades(T, headers, rows)
    st = {r.batch_id: (r.status, r.bad_pos) for r in res.outcome.collect()}
    assert st == {1: ("ok", None), 2: ("invalid_grade", 1), 3: ("not_coordinator", None),
                  4: ("missing_fields", None), 5: ("no_edition", None), 6: ("invalid_grade", 0),
                  7: ("not_enrolled", 0), 8: ("ok", None), 9: ("not_enrolled", 0), 10: ("not_enrolled", 0), 11: ("invalid_grade", 0)}
    ce = {(r.student_id, r.edition_id): (r.grade, r.evaluation_period)
          for r in res.tables["course_enrollment"].collect()}
    assert ce[(1, 100)] == (D("12.00"), "Normal")
    assert ce[(2, 100)] == (D("9.50"), "Normal")      # 9.495 stored half-up: a pass
    assert ce[(3, 101)] == (D("13.00"), "Normal")
    rec = {r.student_id: (r.average, r.approved_courses, r.degree_id)
           for r in refresh_academic_record(dict(T, course_enrollment=res.tables["course_enrollment"])).collect()}
    # a recompute opens a record without a degree too (only the trigger needs one)
    assert rec == {1: (D("12.00"), 1, 7), 2: (D("9.50"), 1, 3), 3: (D("13.00"), 1, None)}


def _q(x):
    return Decimal(x).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def trigger_replay(before, log, degrees):
    """Row trigger, one update at a time (passing update: +1 and average of all
    passing grades now; record opened on the first passing update when the
    student has a degree)."""
    grades = dict(before)
    rec = {}
    for sid, eid, g, *_ in sorted(log, key=lambda r: (r[3], r[4])):
        grades[(sid, eid)] = g
        if g is not None and g >= Decimal("9.5"):
            if sid not in rec:
                if sid not in degrees:
                    continue
                rec[sid] = [0, None]
            ps = [v for (s, _), v in grades.items() if s == sid and v is not None and v >= Decimal("9.5")]
            rec[sid][0] += 1
            rec[sid][1] = _q(sum(ps) / len(ps))
    return {s: (v[1], v[0]) for s, v in rec.items()}


def test_replay_matches_trigger_simulation(spark):
    for seed in range(4):
        rnd = random.Random(seed)
        students, eds = range(4), range(100, 104)
        before = {(s, e): (D(rnd.choice([None, 8, 10, 15.5])) if rnd.random() < 0.8 else None)
                  for s in students for e in eds if rnd.random() < 0.7}
        log = []
        for b in range(8):
            for p in rnd.sample(range(40), 5):
                s, e = rnd.choice(list(before)) if before else (0, 100)
                log.append((s, e, D(rnd.choice([4, 9.5, 9.49, 12, 17.25, 20])), b, p))
        degrees = {0: 2, 1: 1, 3: 4}
        T = campus(spark, degree_enrollment=[(s, d, date(2024, 1, 1)) for s, d in degrees.items()],
                   course_enrollment=[(s, e, g, None, None) for (s, e), g in before.items()])
        changes = spark.createDataFrame(log, "student_id long, edition_id long, grade decimal(5,2), batch_id long, pos long")
        got = {r.student_id: (r.average, r.approved_courses)
               for r in refresh_academic_record(T, "replay", changes=changes, before=T["course_enrollment"]).collect()}
        assert got == trigger_replay(before, log, degrees), seed


def test_recompute_average_exact(spark):
    T = campus(spark, degree_enrollment=[(1, 1, date(2024, 1, 1))],
               course_enrollment=[(1, 100 + i, D(g), None, None) for i, g in enumerate([9.5, 9.51, 19.99, 8])])
    r = refresh_academic_record(T).collect()[0]
    exact = (Decimal("9.5") + Decimal("9.51") + Decimal("19.99")) / 3
    assert r.average == _q(exact) and r.approved_courses == 3
    assert not math.isnan(float(r.average))


def test_recompute_empties_a_record_without_passes(spark):
    T = campus(spark, degree_enrollment=[(1, 1, date(2024, 1, 1))], course_enrollment=[(1, 100, D(8), None, None)],
               academic_record=[(5, 1, D(12), 1, None, 1, date(2024, 1, 1))])
    r = refresh_academic_record(T).collect()
    assert [(x.record_id, x.average, x.approved_courses) for x in r] == [(5, None, 0)]


def test_large_ids_stay_exact_and_copies_do_not_multiply(spark):
    big = 9007199254740993
    T = campus(spark, course_edition=EDS, course_enrollment=[(big, 100, None, None, None)] * 2 + [(big - 1, 100, None, None, None)])
    headers, rows = split_batches(_nested(spark, [(1, 100, 10, "Normal", [[str(big), 12.0]])]))
    res = submit_grades(T, headers, rows)
    assert [r.status for r in res.outcome.collect()] == ["ok"] and res.tables["grade_change"].count() == 1
    got = {(r.student_id, r.grade) for r in res.tables["course_enrollment"].collect()}
    assert got == {(big, D("12.00")), (big - 1, None)}


def test_student_ids_as_they_are_spelled(spark):
    from registrar.operators.grading import _student_id
    texts = {"12": 12, "-1": -1, " 12 ": 12, "+12": 12, "012": 12, "12.": 12, "12.00": 12, "12.5": None, "x": None, "": None, None: None,
             "\x0112": None, "9223372036854775807": 9223372036854775807, "9223372036854775808": None}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.id for r in rows.select("t", _student_id(F.col("t")).alias("id")).collect()} == texts


def test_headers_without_rows_are_told_by_the_join_with_the_rows(spark):
    from registrar.operators.grading import _check_rows, submit_grades
    T = {"course_enrollment": df(spark, "course_enrollment", [(1, 10, None, None, None)]),
         "course_edition": spark.createDataFrame([(10, 5)], "edition_id long, coordinator_id long")}
    headers = spark.createDataFrame([(1, 10, 5, "Normal"), (2, 10, 5, "Normal"), (3, 10, 5, "Normal"), (None, 10, 5, "Normal"), (4, 10, 5, "Normal"), (4, 10, 5, "Normal")],
                                    "batch_id long, edition_id long, submitter_id long, period string")
    rows = spark.createDataFrame([(1, 1, ["1", "12"]), (2, 1, ["1", "12", "0"]), (None, 1, ["1", "12"]), (9, 1, ["1", "12"]), (4, 1, ["7", "9"])],
                                 "batch_id long, pos long, pair array<string>")
    checked = _check_rows(T, headers, rows).collect()
    assert sorted(str(r.batch_id) for r in checked if r.empty) == ["3", "None"]
    out = submit_grades(T, headers, rows)
    got = sorted((str(r.batch_id), r.status, r.bad_pos) for r in out.outcome.collect())
    assert got == [("1", "ok", None), ("2", "ok", None), ("3", "missing_fields", None), ("4", "not_enrolled", 1), ("4", "not_enrolled", 1),
                   ("None", "missing_fields", None)]
    assert [(r.student_id, r.edition_id, float(r.grade)) for r in out.tables["grade_update"].collect()] == [(1, 10, 12.0)]
