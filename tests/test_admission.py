"""W13 against a one-request-at-a-time loop that follows the reference's checks."""

import random
import tempfile

import pytest

from helpers import D, campus

from registrar.operators.admission import admit_to_offering
from registrar.streaming.admissions import AdmissionState, admissions_from_table, announce, run_admissions


def sequential(editions, classes, enrolled, prereq, passed, requests, students):
    """The reference flow, one request after the other, all-or-nothing per request."""
    enrolled = set(enrolled)
    out = {}
    for seq, sid, eid, cls in sorted(requests):
        if not cls:
            out[seq] = "no_classes"
            continue
        if eid not in editions:
            out[seq] = "no_edition"
            continue
        code, cap = editions[eid]
        if sum(1 for (_, e) in enrolled if e == eid) >= cap:
            out[seq] = "full"
        elif (sid, eid) in enrolled:
            out[seq] = "duplicate"
        elif any(p not in passed.get(sid, set()) for c, p in prereq if c == code):
            out[seq] = "prereq"
        elif sid not in students:
            out[seq] = "no_student"
        elif any(classes.get(c) != eid for c in cls):
            out[seq] = "class"
        else:
            enrolled.add((sid, eid))
            out[seq] = "ok"
    return out


def test_random_against_loop(spark):
    for seed in range(6):
        rnd = random.Random(seed)
        editions = {100 + i: (f"C{i}", rnd.randrange(0, 4)) for i in range(4)}
        courses = [(f"C{i}", f"course {i}", 6) for i in range(5)]
        classes = {2 * e + k: e for e in editions for k in (0, 1)}
        prereq = [("C1", "C0"), ("C2", "C4")]
        grades = [(s, 100, D(rnd.choice([8, 12])), None, None) for s in range(3)]
        enrolled = [(s, e) for s, e, *_ in grades]
        passed = {s: {"C0"} for s, _, g, *_ in grades if g >= 9.5}
        reqs = []
        for seq in rnd.sample(range(1000), 30):
            e = rnd.choice(list(editions) + [999])
            cls = rnd.choice([[], [2 * e], [2 * e, 2 * e + 1], [2 * e, 5]])
            reqs.append((seq, rnd.randrange(5), e, cls))
        students = set(range(4))  # student 4 doesn't exist
        T = campus(spark, course=courses, student=[(s, None, None, None, None) for s in students],
                   course_edition=[(e, c, 2024, cap, None, 1) for e, (c, cap) in editions.items()],
                   **{"class": [(k, e, "T", "x") for k, e in classes.items()]},
                   course_enrollment=grades, course_prerequisites=prereq)
        req_df = spark.createDataFrame(reqs, "seq long, student_id long, edition_id long, classes array<long>")
        res = admit_to_offering(T, req_df, parts=4)
        got = {r.seq: r.status for r in res.outcome.collect()}
        exp = sequential(editions, classes, enrolled, prereq, passed, reqs, students)
        assert got == exp, seed
        n_ok = sum(1 for s in exp.values() if s == "ok")
        assert res.tables["course_enrollment"].count() == len(grades) + n_ok
        # accepted never exceed capacity
        per = {}
        for r in res.tables["course_enrollment"].collect():
            per[r.edition_id] = per.get(r.edition_id, 0) + 1
        for e, (_, cap) in editions.items():
            before = sum(1 for _, x in enrolled if x == e)
            assert per.get(e, 0) <= max(cap, before)


def test_hot_offering_spread_over_chunks(spark):
    """One offering receives two thirds of the requests; in 4 partitions its
    running counts span many tasks and must still equal the sequential result."""
    rnd = random.Random(42)
    editions = {100: ("C0", 25), 101: ("C1", 3)}
    classes = {2 * e: e for e in editions}
    reqs = []
    for seq in rnd.sample(range(5000), 90):
        e = 100 if rnd.random() < 0.67 else 101
        reqs.append((seq, rnd.randrange(40), e, [2 * e]))
    T = campus(spark, course=[("C0", "c0", 6), ("C1", "c1", 6)], student=[(s, None, None, None, None) for s in range(40)],
               course_edition=[(e, c, 2024, cap, None, 1) for e, (c, cap) in editions.items()],
               **{"class": [(k, e, "T", "x") for k, e in classes.items()]})
    req_df = spark.createDataFrame(reqs, "seq long, student_id long, edition_id long, classes array<long>")
    got = {r.seq: r.status for r in admit_to_offering(T, req_df, parts=4).outcome.collect()}
    assert got == sequential(editions, classes, [], [], {}, reqs, range(40))
    assert sum(1 for s in got.values() if s == "ok") == 25 + 3


def _random_campus(spark, rnd):
    editions = {100 + i: (f"C{i}", rnd.randrange(0, 6)) for i in range(4)}
    classes = {2 * e + k: e for e in editions for k in (0, 1)}
    grades = [(s, 100, D(rnd.choice([8, 12])), None, None) for s in range(3)]
    reqs = []
    for seq in rnd.sample(range(1000), 60):
        e = rnd.choice([*editions, 101, 999])
        reqs.append((seq, rnd.randrange(9), e, rnd.choice([[], [2 * e], [2 * e, 2 * e + 1], [2 * e, 5]])))
    T = campus(spark, course=[(f"C{i}", f"course {i}", 6) for i in range(5)], student=[(s, None, None, None, None) for s in range(8)],
               course_edition=[(e, c, 2024, cap, None, 1) for e, (c, cap) in editions.items()],
               **{"class": [(k, e, "T", "x") for k, e in classes.items()]},
               student_class=[(0, 200)], course_enrollment=grades, course_prerequisites=[("C1", "C0")])
    return T, reqs


REQ = "seq long, student_id long, edition_id long, classes array<long>"


def test_any_cut_into_deliveries_gives_the_statuses_of_one_batch(spark):
    """Random cuts, an empty delivery, and a delivery that is run again after a failure."""
    rnd = random.Random(11)
    for cuts in ([20, 20, 41], [5]):
        T, reqs = _random_campus(spark, rnd)
        whole = admit_to_offering(T, spark.createDataFrame(reqs, REQ), parts=2)
        state = AdmissionState(spark, tempfile.mkdtemp(prefix="registrar-admissions-", dir="/tmp"), T, every=2)
        state.begin()
        reqs.sort()
        for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(reqs)])):
            part = spark.createDataFrame(reqs[a:b], REQ)
            for _ in range(2 if i == 1 else 1):
                state.admit(part, i)
        assert {r.seq: r.status for r in state.outcome().collect()} == {r.seq: r.status for r in whole.outcome.collect()}
        assert sorted(map(tuple, state.student_class().collect())) == sorted(map(tuple, whole.tables["student_class"].collect()))
        seats = {r.edition_id: r.n for r in state.seats.read().collect()}
        for r in whole.tables["course_enrollment"].groupBy("edition_id").count().collect():
            assert seats.get(r.edition_id, r["count"]) == r["count"]


def test_stream_goes_on_where_it_stopped(spark):
    T, reqs = _random_campus(spark, random.Random(5))
    df = spark.createDataFrame(reqs, REQ)
    whole = {r.seq: r.status for r in admit_to_offering(T, df, parts=2).outcome.collect()}
    assert {r.seq: r.status for r in admissions_from_table(spark, T, df, 2).outcome().collect()} == whole
    work = tempfile.mkdtemp(prefix="registrar-admissions-", dir="/tmp")
    state = AdmissionState(spark, f"{work}/state", T)
    state.begin()
    reqs.sort()
    for i in range(2):  # the second delivery comes after the first run has ended
        spark.createDataFrame(reqs[30 * i:30 * i + 30], REQ).write.parquet(f"{work}/d{i}")
        announce(spark, f"{work}/notices", i, f"{work}/d{i}")
        out = run_admissions(spark, state, f"{work}/notices", work)
    assert {r.seq: r.status for r in out.collect()} == whole
    announce(spark, f"{work}/notices", 7, f"{work}/d1")
    with pytest.raises(Exception, match="announced as number 2"):
        run_admissions(spark, state, f"{work}/notices", work)


def test_class_checks_are_stored_once(spark):
    from registrar.operators.admission import class_check
    T = {"class": spark.createDataFrame([(21, 10, "T", "x")], "class_id long, edition_id long, type string, schedule string")}
    req = spark.createDataFrame([(1, 7, 10, [21]), (2, 7, 10, [21, 22]), (3, 7, 10, [])], "seq long, student_id long, edition_id long, classes array<long>")
    ok, pairs = class_check(T, req)
    assert {r.seq: r.classes_ok for r in ok.collect()} == {1: True, 2: False}
    assert sorted((r.seq, r.class_id) for r in pairs.collect()) == [(1, 21), (2, 21), (2, 22)]
    assert "Join" not in ok._jdf.queryExecution().optimizedPlan().toString() + pairs._jdf.queryExecution().optimizedPlan().toString()
