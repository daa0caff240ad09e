"""JSON request bodies in, JSON results out."""

import json

import pytest

from helpers import D, campus

from registrar.operators.grading import split_batches, submit_grades
from registrar.operators.reports import nest_details
from registrar.sources.requests import grade_bodies, parse_bodies, readable, split_bodies, to_json_rows


def test_parse_registration_and_admission(spark):
    df = spark.createDataFrame([(1, '{"username": "u1", "email": "e@x", "password": "p"}'),
                                (2, '{"username": "u2", "email": "e@x"}'),
                                (3, "not json")], "seq long, body string")
    rows = {r.seq: r for r in parse_bodies(df, "registration").collect()}
    assert rows[1].password_present is True and rows[1].username == "u1"
    assert rows[2].password_present is None and rows[3].username is None
    adm = spark.createDataFrame([(1, 5, 100, '{"classes": [200, 201]}'), (2, 5, 100, "{}")],
                                "seq long, student_id long, edition_id long, body string")
    got = {r.seq: r.classes for r in parse_bodies(adm, "admission_request").collect()}
    assert got == {1: [200, 201], 2: None}


def test_grade_body_to_batches(spark):
    T = campus(spark, course_edition=[(100, "EI", 2024, 5, None, 10)],
               course_enrollment=[(1, 100, None, None, None)])
    bodies = spark.createDataFrame([(7, 100, 10, '{"period": "Normal", "grades": [[1, 13.5], [1]]}')],
                                   "batch_id long, edition_id long, submitter_id long, body string")
    headers, rows = split_batches(parse_bodies(bodies, "grade_batch"))
    res = submit_grades(T, headers, rows)
    assert [(r.status, r.bad_pos) for r in res.outcome.collect()] == [("ok", None)]
    assert [r.grade for r in res.tables["course_enrollment"].collect()] == [D("13.50")]


def test_json_result_keeps_nulls_and_nesting(spark):
    T = campus(spark, course=[("EI", "Eng", 6)], course_edition=[(100, "EI", 2024, 5, None, 10)],
               course_enrollment=[(1, 100, D(12), None, None)])
    students = spark.createDataFrame([(1, "Ana", 12.0), (2, None, 11.0)], "student_id long, student_name string, average_grade double")
    rows = [json.loads(r.json) for r in to_json_rows(nest_details(T, students, 2024)).collect()]
    by_id = {r["student_id"]: r for r in rows}
    assert by_id[2]["student_name"] is None and "student_name" in by_id[2]
    assert by_id[1]["grades"] == [{"course_edition_id": 100, "course_edition_name": "Eng - 2024",
                                   "grade": 12.0, "date": "2024-01-01"}]
    assert by_id[2]["grades"] == [] and by_id[1]["activities"] == []


def test_grade_body_with_entries_that_are_not_numbers(spark):
    T = campus(spark, course_edition=[(100, "EI", 2024, 5, None, 10)], course_enrollment=[(1, 100, None, None, None)])
    bodies = spark.createDataFrame([(1, 100, 10, '{"period": "Normal", "grades": [[1, "bad"]]}'),
                                    (2, 100, 10, '{"period": "Normal", "grades": [[1, 12], [1, "x", 3]]}')],
                                   "batch_id long, edition_id long, submitter_id long, body string")
    out = submit_grades(T, *split_batches(parse_bodies(bodies, "grade_batch"))).outcome.collect()
    assert {r.batch_id: r.status for r in out} == {1: "invalid_grade", 2: "ok"}


BAD = ['{"a":1} x', '{"a":1', "not json", "[1]", "null", '"x"', "", None, '{"a":1},{"a":2}', '{"a":1}],[2', '{"a":1},"c":2',
       '{"a":1}},{"b":{', '{"a":1,"a":2}', '{"a":NaN}', "{'a':1}", "1", "{}{}"]
FINE = ["{}", ' {"a": [1, {"b": null}]} ', '{"username": 5}', '{"a": "}],[ é \\u00e9"}']


def test_unreadable_bodies_are_told_from_missing_fields(spark):
    df = spark.createDataFrame(list(enumerate(FINE + BAD)), "seq long, body string")
    from pyspark.sql import functions as F
    got = {r.seq: r.ok for r in df.select("seq", readable(F.col("body")).alias("ok")).collect()}
    assert got == {i: i < len(FINE) for i in range(len(FINE + BAD))}
    requests, rejects = split_bodies(df, "registration")
    assert {r.seq for r in requests.collect()} == set(range(len(FINE)))
    assert {(r.seq, r.body, r.status) for r in rejects.collect()} == {(i, b, "bad_json") for i, b in enumerate(FINE + BAD) if i >= len(FINE)}


@pytest.mark.parametrize("part_rows", [1, 3, 100])
def test_batches_in_parts_equal_whole_ones(spark, part_rows):
    T = campus(spark, course_edition=[(100, "EI", 2024, 50, None, 10)], course_enrollment=[(i, 100, None, None, None) for i in range(9)])
    headers = spark.createDataFrame([(b, 100, 10, None if b == 3 else "Normal") for b in range(4)],
                                    "batch_id long, edition_id long, submitter_id long, period string")
    pairs = [(b, i, [str(i), "25" if (b, i) == (1, 7) else "12.5"] if i != 4 else ["4"]) for b in range(4) for i in range(9 if b != 2 else 2)]
    rows = spark.createDataFrame(pairs, "batch_id long, pos long, pair array<string>")
    want = submit_grades(T, headers, rows)
    bodies = grade_bodies(headers, rows, part_rows)
    assert bodies.count() == sum(-(-n // part_rows) for n in (9, 9, 2, 9))
    sent = bodies.unionByName(bodies.where("batch_id = 0"))  # a part may come twice
    got = submit_grades(T, *split_batches(parse_bodies(sent, "grade_batch")))
    assert sorted(map(str, got.outcome.collect())) == sorted(map(str, want.outcome.collect()))
    assert {r.batch_id: r.bad_pos for r in got.outcome.collect()}[1] == 7
    assert sorted(map(str, got.tables["course_enrollment"].collect())) == sorted(map(str, want.tables["course_enrollment"].collect()))


def test_a_batch_with_a_part_missing_is_refused_whole(spark):
    T = campus(spark, course_edition=[(100, "EI", 2024, 50, None, 10)], course_enrollment=[(i, 100, None, None, None) for i in range(3)])
    sent = spark.createDataFrame([(1, 100, 10, '{"period": "Normal", "grades": [[0, 12]], "first": 0, "total": 3}'),
                                  (1, 100, 10, '{"period": "Normal", "grades": [[2, 12]], "first": 2, "total": 3}'),
                                  (2, 100, 10, '{"period": "Normal", "grades": [], "total": 0}')],
                                 "batch_id long, edition_id long, submitter_id long, body string")
    res = submit_grades(T, *split_batches(parse_bodies(sent, "grade_batch")))
    assert {r.batch_id: r.status for r in res.outcome.collect()} == {1: "incomplete", 2: "missing_fields"}
    assert res.tables["course_enrollment"].where("grade is not null").count() == 0
