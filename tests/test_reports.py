"""Read reports on hand-made rows, one case per semantic decision."""

from datetime import date

from helpers import D, campus

from registrar.operators import reports as R

USERS = [(10, "prof1", None, "instructor"), (11, "prof2", None, "instructor"),
         (1, "student1", None, "student"), (2, "student2", None, "student"), (3, "student3", None, "student")]
STUDENTS = [(1, "Ana", None, None, "Coimbra"), (2, "Rui", None, None, "Coimbra"), (3, "Eva", None, None, None),
            (4, "Rita", None, None, "Aveiro")]
COURSES = [("EI", "Eng Inf", 180), ("CD", "Ciencia Dados", 120), ("MA", "Mat Apl", 180)]
EDITIONS = [(100, "EI", 2024, 2, None, 10), (101, "CD", 2024, 50, None, 11), (102, "MA", 2023, 5, None, 99)]


def base(spark, enrol, **extra):
    return campus(spark, users=USERS, student=STUDENTS, course=COURSES, course_edition=EDITIONS,
                  course_enrollment=enrol, **extra)


def test_transcript_coordinator_optional_and_newest_first(spark):
    T = base(spark, [(1, 100, D(12), 3, "Normal"), (1, 102, D(8), 1, "Recurso")])
    rows = R.transcript(T, [1]).collect()
    assert [r.course_edition_id for r in rows] == [100, 102]
    assert rows[0].coordinator_name == "prof1" and rows[1].coordinator_name is None  # coordinator 99 unknown


def test_offering_stats_modes(spark):
    enrol = [(1, 100, D(12), None, None), (2, 100, D(9.49), None, None), (3, 100, None, None, None)]
    ia = [(10, 100, True), (11, 100, False)]
    dc = [(1, "EI"), (1, "CD")]
    T = base(spark, enrol, instructor_assignment=ia, degree_courses=dc)
    correct = {r.course_edition_id: r for r in R.offering_stats(T, 1).collect()}
    assert (correct[100].enrolled_count, correct[100].approved_count) == (3, 1)
    assert correct[100].instructors == [10, 11]
    assert correct[101].enrolled_count == 0 and correct[101].instructors == []   # kept, empty array
    fan = {r.course_edition_id: r for r in R.offering_stats(T, 1, "fanout").collect()}
    assert (fan[100].enrolled_count, fan[100].approved_count) == (6, 2)           # x 2 instructors
    nonempty = [r.course_edition_id for r in R.offering_stats(T, None, "nonempty").collect()]
    assert nonempty == [100]


def test_top_n_tie_broken_by_student_id(spark):
    enrol = [(2, 100, D(15), None, None), (1, 101, D(15), None, None), (4, 100, D(14), None, None),
             (3, 101, D(16), None, None)]
    T = base(spark, enrol)
    assert [r.student_id for r in R.top_n_by_average(T, 2024, 3).collect()] == [3, 1, 2]


def test_average_is_exact_half_up(spark):
    # (9.49 + 9.50) / 2 = 9.495 -> 9.50 (half away from zero, computed exactly)
    T = base(spark, [(1, 100, D(9.49), None, None), (1, 101, D(9.50), None, None)])
    assert R.student_averages(T).collect()[0].average_grade == 9.5


def test_top_by_group_keeps_ties_and_drops_null_groups(spark):
    enrol = [(1, 100, D(15), None, None), (2, 101, D(15), None, None), (3, 100, D(19), None, None),
             (4, 100, None, None, None)]
    T = base(spark, enrol)
    rows = {(r.student_id, r.district) for r in R.top_by_group(T).collect()}
    assert rows == {(1, "Coimbra"), (2, "Coimbra")}   # tie kept; Eva has no district; Rita no grade


def test_evaluation_stats_and_best_per_period(spark):
    eds = [(100, "EI", 2024, 2, None, 10), (101, "CD", 2024, 5, None, 11), (102, "MA", 2022, 5, None, 10)]
    enrol = [(1, 100, D(12), None, None), (2, 101, D(10), None, None), (3, 102, D(20), None, None),
             (4, 101, None, None, None)]
    T = campus(spark, course=COURSES, course_edition=eds, course_enrollment=enrol)
    stats = {r.course_edition_id: r for r in R.evaluation_stats(T, date(2024, 6, 1)).collect()}
    assert set(stats) == {100, 101} and stats[100].month == "2024-01"
    best = R.best_per_period(R.evaluation_stats(T, date(2024, 6, 1))).collect()
    assert [(b.month, b.course_edition_id) for b in best] == [("2024-01", 100)]   # tie 1-1 -> smaller id


def test_missing_prerequisites_and_seats(spark):
    eds = [(100, "EI", 2023, 1, None, 10), (101, "CD", 2024, 2, None, 11)]
    enrol = [(1, 100, D(9.5), None, None), (2, 100, D(9.4), None, None)]
    T = campus(spark, course=COURSES, course_edition=eds, course_enrollment=enrol,
               course_prerequisites=[("CD", "EI"), ("CD", "MA")])
    pairs = spark.createDataFrame([(1, "CD"), (2, "CD"), (3, "EI")], "student_id long, course_code string")
    got = {(r.student_id, r.course_code): (r.missing_count, r.missing) for r in R.missing_prerequisites(T, pairs).collect()}
    assert got == {(1, "CD"): (1, ["MA"]), (2, "CD"): (2, ["EI", "MA"]), (3, "EI"): (0, [])}
    seats = {r.edition_id: (r.enrolled, r.seats_left, r.is_full) for r in R.seat_availability(T).collect()}
    assert seats == {100: (2, -1, True), 101: (0, 2, False)}
