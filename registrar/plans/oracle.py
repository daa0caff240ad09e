"""Oracle SQL (DuckDB dialect) for each registered query, written independently of
the Spark operators. Averages are compared exactly through integer hundredths:
``(2*sum_cents + n) // (2*n) / 100``.
"""

from __future__ import annotations

from registrar.plans.oracle_tables import with_tables

AVG = "CAST((2 * s + n) // (2 * n) AS DOUBLE) / 100"

SQL: dict[str, str] = {}


def sql(name: str, body: str, extra=None):
    SQL[name] = with_tables(body, extra)


# Offerings with their course and, where there is one, the coordinator's name.
_OFFERING = """
SELECT o.edition_id, o.year, o.capacity, o.coordinator_id, k.code, k.name AS title,
       (SELECT max(p.username) FROM d_users p WHERE p.user_id = o.coordinator_id) AS coordinator
FROM d_course_edition o, d_course k WHERE k.code = o.course_code"""

_TRANSCRIPT = """
SELECT g.student_id, g.edition_id AS course_edition_id, o.title AS course_name, o.year AS course_edition_year,
       CAST(g.grade AS DOUBLE) AS grade, g.evaluation_period, g.attendance, o.code AS course_code,
       o.coordinator_id, o.coordinator AS coordinator_name
FROM offering o INNER JOIN d_course_enrollment g USING (edition_id)"""

sql("transcript", _TRANSCRIPT, [("offering", _OFFERING)])
sql("transcript_chosen", _TRANSCRIPT + " WHERE g.student_id % 100 = 1", [("offering", _OFFERING)])

# Seats taken, passes and teachers of an offering, each counted on its own.
_TALLY = """
SELECT o.edition_id, o.code, o.title, o.year, o.capacity, o.coordinator_id,
       (SELECT count(*) FROM d_course_enrollment g WHERE g.edition_id = o.edition_id) AS taken,
       (SELECT count(*) FROM d_course_enrollment g WHERE g.edition_id = o.edition_id AND g.grade >= 9.5) AS passes,
       coalesce(t.teachers, []) AS teachers
FROM offering o
LEFT JOIN (SELECT edition_id, list(instructor_id ORDER BY instructor_id) AS teachers
           FROM (SELECT DISTINCT edition_id, instructor_id FROM d_instructor_assignment) GROUP BY edition_id) t
  USING (edition_id)"""


def _offering_rows(times: str, degree: str, source: str) -> str:
    return f"""
SELECT {degree}t.code AS course_id, t.title AS course_name, t.edition_id AS course_edition_id, t.year AS course_edition_year,
       t.capacity, CAST(t.taken * {times} AS BIGINT) AS enrolled_count, CAST(t.passes * {times} AS BIGINT) AS approved_count,
       t.coordinator_id, array_to_string(t.teachers, ',') AS instructors
FROM {source}"""


_TALLIES = [("offering", _OFFERING), ("tally", _TALLY)]
_WITH_DEGREE = "d_degree_courses dc JOIN tally t ON t.code = dc.course_code"
_FAN = "greatest(len(t.teachers), 1)"  # each enrolment meets each teacher, or none once

sql("offering_stats", _offering_rows("1", "dc.degree_id, ", _WITH_DEGREE), _TALLIES)
sql("offering_stats_degree", _offering_rows("1", "dc.degree_id, ", _WITH_DEGREE) + " WHERE dc.degree_id = 2", _TALLIES)
sql("offering_stats_fanout", _offering_rows(_FAN, "dc.degree_id, ", _WITH_DEGREE), _TALLIES)
sql("offering_stats_nonempty", _offering_rows(_FAN, "", "tally t") + " WHERE t.taken > 0", _TALLIES)

_YEAR_AVG = f"""
SELECT g.student_id, st.name AS student_name, {AVG} AS average_grade
FROM (SELECT ce.student_id, sum(CAST(ce.grade * 100 AS BIGINT)) AS s, count(ce.grade) AS n
      FROM d_course_enrollment ce JOIN d_course_edition ed ON ce.edition_id = ed.edition_id
      WHERE ce.grade IS NOT NULL AND ed.year = 2000 GROUP BY ce.student_id) g
JOIN d_student st ON st.user_id = g.student_id
ORDER BY average_grade DESC, g.student_id LIMIT 3"""

sql("top_n_by_average", _YEAR_AVG)

sql("nest_grades", """
SELECT t.student_id, ce.edition_id AS course_edition_id, c.name || ' - ' || CAST(ed.year AS VARCHAR) AS course_edition_name,
       CAST(ce.grade AS DOUBLE) AS grade, CAST(ed.year AS VARCHAR) || '-01-01' AS date
FROM top3 t
JOIN d_course_enrollment ce ON ce.student_id = t.student_id AND ce.grade IS NOT NULL
JOIN d_course_edition ed ON ce.edition_id = ed.edition_id AND ed.year = 2000
JOIN d_course c ON ed.course_code = c.code""", [("top3", _YEAR_AVG)])

sql("nest_activities", """
SELECT t.student_id, x.name AS activity
FROM top3 t LEFT JOIN (SELECT ap.student_id, a.name FROM d_activity_participation ap
                       JOIN d_activity a ON a.activity_id = ap.activity_id) x ON x.student_id = t.student_id""",
    [("top3", _YEAR_AVG)])

sql("top_overall", f"""
SELECT student_id, student_name, average_grade FROM (
    SELECT g.student_id, p.name AS student_name, {AVG} AS average_grade
    FROM (SELECT student_id, sum(CAST(grade * 100 AS BIGINT)) AS s, count(grade) AS n FROM d_course_enrollment
          GROUP BY student_id HAVING count(grade) > 0) g, d_student p WHERE p.user_id = g.student_id)
ORDER BY average_grade DESC, student_id LIMIT 3""")

sql("top_by_group", f"""
WITH mean AS (
    SELECT p.user_id AS student_id, p.district, {AVG} AS average_grade
    FROM d_student p, (SELECT student_id, sum(CAST(grade * 100 AS BIGINT)) AS s, count(grade) AS n
                       FROM d_course_enrollment GROUP BY student_id HAVING count(grade) > 0) g
    WHERE g.student_id = p.user_id AND p.district IS NOT NULL),
best AS (SELECT district, max(average_grade) AS average_grade FROM mean GROUP BY district)
SELECT mean.student_id, district, average_grade FROM mean JOIN best USING (district, average_grade)""")

_EVAL = """
SELECT CAST(o.year AS VARCHAR) || '-01' AS month, o.edition_id AS course_edition_id, o.title AS course_edition_name,
       g.approved, g.evaluated
FROM offering o
JOIN (SELECT edition_id, count(grade) AS evaluated, count(CASE WHEN grade >= 9.5 THEN 1 END) AS approved
      FROM d_course_enrollment GROUP BY edition_id HAVING count(grade) > 0) g USING (edition_id)
WHERE o.year >= 2000"""

sql("evaluation_stats", _EVAL, [("offering", _OFFERING)])

sql("best_per_period", """
SELECT month, min(course_edition_id) AS course_edition_id, arg_min(course_edition_name, course_edition_id) AS course_edition_name,
       approved, arg_min(evaluated, course_edition_id) AS evaluated
FROM es WHERE (month, approved) IN (SELECT (month, max(approved)) FROM es GROUP BY month)
GROUP BY month, approved""", [("offering", _OFFERING), ("es", _EVAL)])

_BEST = _EVAL.replace("o.year >= 2000", "g.approved > 0")
sql("stored_best_roster", """
WITH top AS (SELECT course_edition_id AS edition_id FROM es ORDER BY approved DESC, month DESC, course_edition_id LIMIT 1)
SELECT edition_id, student_id, CAST(grade AS DOUBLE) AS grade, evaluation_period
FROM d_course_enrollment JOIN top USING (edition_id)""", [("offering", _OFFERING), ("es", _BEST)])

# Courses passed by students, and what a student still lacks for a course.
_PASSED = """SELECT DISTINCT g.student_id, o.code FROM d_course_enrollment g JOIN offering o USING (edition_id) WHERE g.grade >= 9.5"""
_LACKS = """
SELECT w.student_id, w.course_code, need.prerequisite_code
FROM wanted w JOIN d_course_prerequisites need USING (course_code)
ANTI JOIN passed ON passed.student_id = w.student_id AND passed.code = need.prerequisite_code"""

sql("missing_prerequisites", """
SELECT w.student_id, w.course_code, count(l.prerequisite_code) AS missing_count,
       coalesce(string_agg(l.prerequisite_code, ',' ORDER BY l.prerequisite_code), '') AS missing
FROM wanted w LEFT JOIN lacks l USING (student_id, course_code) GROUP BY ALL""",
    [("offering", _OFFERING), ("passed", _PASSED),
     ("wanted", "SELECT DISTINCT g.student_id, o.course_code FROM d_course_enrollment g JOIN d_course_edition o USING (edition_id)"),
     ("lacks", _LACKS)])

sql("seat_availability", """
SELECT ed.edition_id, ed.capacity, CAST(coalesce(n.k, 0) AS BIGINT) AS enrolled,
       ed.capacity - coalesce(n.k, 0) AS seats_left, coalesce(n.k, 0) >= ed.capacity AS is_full
FROM d_course_edition ed
LEFT JOIN (SELECT edition_id, count(*) AS k FROM d_course_enrollment GROUP BY edition_id) n ON n.edition_id = ed.edition_id""")

# ---------------------------------------------------------------- admission (sequential meaning in SQL)
# What is known of each request before the batch, then earlier good requests and claims.
_FACTS = """
SELECT r.seq, r.student_id, r.edition_id, o.capacity, len(r.classes) > 0 AS has_classes, o.edition_id IS NOT NULL AS is_there,
       (SELECT count(*) FROM d_course_enrollment g WHERE g.edition_id = r.edition_id) AS taken,
       (r.student_id, r.edition_id) IN (SELECT (student_id, edition_id) FROM d_course_enrollment) AS enrolled,
       (r.student_id, o.code) NOT IN (SELECT (student_id, course_code) FROM lacks) OR o.code IS NULL AS ready,
       r.student_id IN (SELECT user_id FROM d_student) AS is_student,
       len(r.classes) > 0 AND NOT EXISTS (SELECT 1 FROM unnest(r.classes) AS c(id)
            WHERE (c.id, r.edition_id) NOT IN (SELECT (class_id, edition_id) FROM d_class)) AS own_classes
FROM r_admission r LEFT JOIN offering o ON o.edition_id = r.edition_id"""

_ADMIT = """
WITH good AS (SELECT *, is_there AND NOT enrolled AND ready AND is_student AND own_classes AS fit FROM facts),
first_of AS (SELECT edition_id, student_id, min(seq) AS first_seq FROM good WHERE fit GROUP BY edition_id, student_id),
claims AS (SELECT edition_id, seq, row_number() OVER (PARTITION BY edition_id ORDER BY seq) AS place
           FROM good JOIN first_of USING (edition_id, student_id) WHERE fit AND seq = first_seq),
seen AS (SELECT good.*, coalesce(f.first_seq < good.seq, false) AS asked_before, coalesce(c.place, 0) AS claimed
         FROM good LEFT JOIN first_of f USING (edition_id, student_id)
         ASOF LEFT JOIN claims c ON c.edition_id = good.edition_id AND c.seq < good.seq)
SELECT seq, student_id, edition_id,
       CASE WHEN NOT has_classes THEN 'no_classes' WHEN NOT is_there THEN 'no_edition'
            WHEN taken + claimed >= capacity THEN 'full' WHEN enrolled OR asked_before THEN 'duplicate'
            WHEN NOT ready THEN 'prereq' WHEN NOT is_student THEN 'no_student' WHEN NOT own_classes THEN 'class' ELSE 'ok' END AS status
FROM seen"""

_ADMITTED = [("offering", _OFFERING), ("passed", _PASSED),
             ("wanted", "SELECT DISTINCT r.student_id, o.course_code FROM r_admission r JOIN d_course_edition o USING (edition_id)"),
             ("lacks", _LACKS), ("facts", _FACTS)]

sql("admit_to_offering", _ADMIT, _ADMITTED)
sql("stream_admission", _ADMIT, _ADMITTED)

sql("assign_classes", """
SELECT DISTINCT r.student_id, c.id AS class_id
FROM r_admission r JOIN facts f USING (seq), unnest(r.classes) AS c(id) WHERE f.own_classes""", _ADMITTED)

sql("student_class_after_admission", """
SELECT student_id, class_id FROM d_student_class
UNION SELECT r.student_id, c.id FROM r_admission r JOIN adm USING (seq), unnest(r.classes) AS c(id) WHERE adm.status = 'ok'""",
    [*_ADMITTED, ("adm", _ADMIT)])

sql("enrollment_after_admission", """
SELECT student_id, edition_id, CAST(grade AS DOUBLE) AS grade, attendance, evaluation_period FROM d_course_enrollment
UNION ALL SELECT student_id, edition_id, NULL, NULL, NULL FROM adm WHERE status = 'ok'""", [*_ADMITTED, ("adm", _ADMIT)])

# ---------------------------------------------------------------- ingest
_REG = """
WITH x AS (
    SELECT r.*, coalesce(length(username) > 0 AND length(email) > 0 AND password_present, false) AS f,
           EXISTS (SELECT 1 FROM d_users u WHERE u.username = r.username) AS ex
    FROM r_registration r),
fst AS (SELECT username, min(seq) AS s0 FROM x WHERE f AND NOT ex GROUP BY username),
st AS (SELECT x.seq, x.username, x.email,
              CASE WHEN NOT x.f THEN 'missing_fields' WHEN x.ex THEN 'username_exists'
                   WHEN x.seq <> fst.s0 THEN 'duplicate_in_batch' ELSE 'ok' END AS status
       FROM x LEFT JOIN fst ON fst.username = x.username)
SELECT seq, username, status,
       CASE WHEN status = 'ok' THEN (SELECT max(user_id) FROM d_users)
            + row_number() OVER (PARTITION BY status = 'ok' ORDER BY seq) END AS user_id
FROM st"""

sql("register_users", _REG)

_SENT = """
WITH t AS (SELECT seq, '{' || concat_ws(',', '"username":"' || username || '"', '"email":"' || email || '"',
                  CASE WHEN password_present THEN '"password":"p' || CAST(seq AS VARCHAR) || '"' END) || '}' AS txt FROM r_registration)
SELECT seq, CASE WHEN seq % 37 = 0 THEN left(txt, -1) WHEN seq % 41 = 0 THEN '[' || txt || ']'
                 WHEN seq % 43 = 0 THEN txt || ' ,' ELSE txt END AS body FROM t"""
_GOOD = """
SELECT r.* FROM r_registration r JOIN sent USING (seq)
WHERE json_valid(sent.body) AND CASE WHEN json_valid(sent.body) THEN json_type(sent.body) = 'OBJECT' END"""
sql("register_users_json", """
SELECT seq, username, status, user_id, CAST(NULL AS VARCHAR) AS body FROM reg
UNION ALL SELECT seq, NULL, 'bad_json', NULL, body FROM sent ANTI JOIN fine USING (seq)""",
    [("sent", _SENT), ("fine", _GOOD), ("reg", _REG.replace("r_registration", "fine"))])

# The users table after registrations of a role, and that role's own table.
for _role, _own in (("student", "d_student"), ("instructor", "d_instructor"), ("admin", "d_admin")):
    sql(f"users_after_{_role}s", f"""
SELECT user_id, username, email, role FROM d_users
UNION ALL SELECT g.user_id, g.username, r.email, '{_role}' FROM reg g JOIN r_registration r USING (seq) WHERE g.status = 'ok'""",
        [("reg", _REG)])
    _more = "is_coordinator" if _role == "instructor" else "CAST(NULL AS BOOLEAN)"
    _new = "coalesce(r.is_coordinator, false)" if _role == "instructor" else "CAST(NULL AS BOOLEAN)"
    sql(f"{_role}s_registered", f"""
SELECT user_id, {_more} AS is_coordinator FROM {_own}
UNION ALL SELECT g.user_id, {_new} FROM reg g JOIN r_registration r USING (seq) WHERE g.status = 'ok'""", [("reg", _REG)])

_ABSENT = """
SELECT r.seq, r.username, r.email,
       CASE WHEN r.username IS NULL THEN 'null_key' WHEN u.username IS NOT NULL THEN 'exists'
            WHEN r.seq > min(r.seq) OVER (PARTITION BY r.username) THEN 'duplicate_in_batch' ELSE 'ok' END AS status
FROM r_registration r LEFT JOIN (SELECT DISTINCT username FROM d_users) u USING (username)"""

sql("insert_if_absent", """
SELECT user_id, username, email, role FROM d_users
UNION ALL SELECT (SELECT max(user_id) FROM d_users) + rank() OVER (ORDER BY seq), username, email, 'student'
FROM absent WHERE status = 'ok'""", [("absent", _ABSENT)])
sql("insert_if_absent_outcome", "SELECT seq, username, status FROM absent", [("absent", _ABSENT)])

_DEG = """
WITH x AS (
    SELECT r.*, r.student_id IS NOT NULL AND r.date IS NOT NULL AND r.degree_id IS NOT NULL AS f,
           r.student_id IN (SELECT user_id FROM d_student) AS st,
           r.degree_id IN (SELECT degree_id FROM d_degree_program) AS dg,
           NOT EXISTS (SELECT 1 FROM d_degree_enrollment de WHERE de.student_id = r.student_id AND de.degree_id = r.degree_id) AS nw
    FROM r_degree r),
fst AS (SELECT student_id, degree_id, min(seq) AS s0 FROM x WHERE f AND st AND dg AND nw GROUP BY student_id, degree_id)
SELECT x.seq, x.student_id, x.degree_id, x.date,
       CASE WHEN NOT coalesce(x.f, false) THEN 'missing_fields' WHEN NOT coalesce(x.st, false) THEN 'no_student'
            WHEN NOT coalesce(x.dg, false) THEN 'no_degree' WHEN NOT x.nw THEN 'already_enrolled'
            WHEN x.seq <> fst.s0 THEN 'already_enrolled' ELSE 'ok' END AS status
FROM x LEFT JOIN fst ON fst.student_id = x.student_id AND fst.degree_id = x.degree_id"""

sql("enroll_degree", "SELECT seq, student_id, degree_id, status FROM deg", [("deg", _DEG)])

sql("post_tuition", """
WITH added AS (SELECT d.student_id, sum(dp.tuition_fee) AS a FROM deg d JOIN d_degree_program dp ON dp.degree_id = d.degree_id
               WHERE d.status = 'ok' GROUP BY d.student_id)
SELECT fa.account_id, fa.student_id, CAST(fa.balance + coalesce(a.a, 0) AS DOUBLE) AS balance
FROM d_financial_account fa LEFT JOIN added a ON a.student_id = fa.student_id
UNION ALL
SELECT (SELECT max(account_id) FROM d_financial_account) + row_number() OVER (ORDER BY a.student_id), a.student_id,
       CAST(a.a AS DOUBLE)
FROM added a WHERE a.student_id NOT IN (SELECT student_id FROM d_financial_account)""", [("deg", _DEG)])

_ACT = """
WITH x AS (
    SELECT r.*, a.fee, a.activity_id IS NOT NULL AS ok_a,
           NOT EXISTS (SELECT 1 FROM d_activity_participation p WHERE p.student_id = r.student_id AND p.activity_id = r.activity_id) AS nw,
           r.student_id IN (SELECT student_id FROM d_financial_account) AS acc,
           r.student_id IN (SELECT user_id FROM d_student) AS st
    FROM r_activity r LEFT JOIN d_activity a ON a.activity_id = r.activity_id),
fst AS (SELECT student_id, activity_id, min(seq) AS s0 FROM x WHERE ok_a AND nw AND st GROUP BY student_id, activity_id)
SELECT x.seq, x.student_id, x.activity_id, x.fee, x.acc,
       CASE WHEN NOT x.ok_a THEN 'no_activity' WHEN NOT x.nw THEN 'already_enrolled' WHEN NOT x.st THEN 'no_student'
            WHEN x.seq <> fst.s0 THEN 'already_enrolled' ELSE 'ok' END AS status
FROM x LEFT JOIN fst ON fst.student_id = x.student_id AND fst.activity_id = x.activity_id"""

sql("enroll_activity", """
SELECT seq, student_id, activity_id, status, CASE WHEN status = 'ok' THEN acc END AS fee_posted FROM act""",
    [("act", _ACT)])

sql("activity_balances", """
SELECT fa.account_id, fa.student_id, CAST(fa.balance + coalesce(f.s, 0) AS DOUBLE) AS balance
FROM d_financial_account fa
LEFT JOIN (SELECT student_id, sum(fee) AS s FROM act WHERE status = 'ok' GROUP BY student_id) f ON f.student_id = fa.student_id""",
    [("act", _ACT)])

_VALID = "SELECT DISTINCT r.student_id FROM r_erasure r JOIN d_users u ON u.user_id = r.student_id AND u.role = 'student'"

sql("erase_students", """
SELECT r.seq, r.student_id, CASE WHEN v.student_id IS NOT NULL THEN 'ok' ELSE 'not_student' END AS status
FROM r_erasure r LEFT JOIN valid v USING (student_id)""", [("valid", _VALID)])

# Rows left per table; the column that names the student where it isn't student_id.
_HELD = {"academic_record": "", "activity_participation": "", "course_enrollment": "", "degree_enrollment": "",
         "financial_account": "", "student": "user_id", "student_class": "", "users": "user_id"}
sql("erase_students_tables", """
UNION ALL """.join(
    [f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM d_{t} x ANTI JOIN valid v ON v.student_id = x.{c or 'student_id'}\n"
     for t, c in _HELD.items()]
    + ["SELECT 'financial_transaction', count(*) FROM d_financial_transaction x JOIN d_financial_account a USING (account_id) "
       "ANTI JOIN valid v ON v.student_id = a.student_id"]), [("valid", _VALID)])

# ---------------------------------------------------------------- grading
_ROWS = """
SELECT g.batch_id, g.pos, b.edition_id, b.period,
       g.p_student AS student_id, g.p_grade,
       CASE WHEN NOT (g.p_grade IS NOT NULL AND NOT isnan(g.p_grade) AND g.p_grade >= 0 AND g.p_grade <= 20) THEN 'invalid_grade'
            WHEN NOT EXISTS (SELECT 1 FROM d_course_enrollment e WHERE e.edition_id = b.edition_id
                             AND e.student_id = g.p_student)
                 THEN 'not_enrolled'
            ELSE 'ok' END AS reason
FROM r_grade_row g JOIN r_grade_batch b ON b.batch_id = g.batch_id
WHERE g.p_size = 2"""

_BATCH = """
WITH h AS (
    SELECT b.batch_id, b.edition_id,
           CASE WHEN coalesce(length(b.period), 0) = 0 OR coalesce(n.k, 0) = 0 THEN 'missing_fields'
                WHEN ed.edition_id IS NULL THEN 'no_edition'
                WHEN NOT coalesce(b.submitter_id = ed.coordinator_id, false) THEN 'not_coordinator'
                ELSE 'ok' END AS head
    FROM r_grade_batch b LEFT JOIN d_course_edition ed ON ed.edition_id = b.edition_id
    LEFT JOIN (SELECT batch_id, count(*) AS k FROM r_grade_row GROUP BY batch_id) n ON n.batch_id = b.batch_id),
bad AS (SELECT batch_id, arg_min(reason, pos) AS reason, min(pos) AS pos FROM grows WHERE reason <> 'ok' GROUP BY batch_id)
SELECT h.batch_id, h.edition_id,
       CASE WHEN h.head <> 'ok' THEN h.head WHEN bad.reason IS NOT NULL THEN bad.reason ELSE 'ok' END AS status,
       CASE WHEN h.head = 'ok' THEN bad.pos END AS bad_pos
FROM h LEFT JOIN bad ON bad.batch_id = h.batch_id"""

sql("submit_grades", "SELECT * FROM batches", [("grows", _ROWS), ("batches", _BATCH)])
sql("submit_grades_json", "SELECT * FROM batches", [("grows", _ROWS), ("batches", _BATCH)])

_APPLIED = """
SELECT g.student_id, g.edition_id, CAST(g.p_grade AS DECIMAL(5,2)) AS grade, g.period, g.batch_id, g.pos
FROM grows g JOIN batches b ON b.batch_id = g.batch_id AND b.status = 'ok'"""

_NEW_CE = """
SELECT e.student_id, e.edition_id,
       CASE WHEN l.student_id IS NOT NULL THEN l.grade ELSE e.grade END AS grade
FROM d_course_enrollment e
LEFT JOIN (SELECT student_id, edition_id, grade FROM (
               SELECT *, row_number() OVER (PARTITION BY student_id, edition_id ORDER BY batch_id DESC, pos DESC) AS rn
               FROM applied) z WHERE rn = 1) l
  ON l.student_id = e.student_id AND l.edition_id = e.edition_id"""

_DEG_MIN = """SELECT student_id, min(degree_id) AS degree_id, arg_min(enrollment_date, degree_id) AS enrollment_date
              FROM d_degree_enrollment GROUP BY student_id"""

# Records: the old ones keep their id, degree and date; new ones are numbered by student.
def _records(keep: str, new_needs_degree: bool, average: str, courses: str) -> str:
    join = "JOIN" if new_needs_degree else "LEFT JOIN"
    return f"""
SELECT o.record_id, o.student_id, {keep}, o.degree_id, o.enrollment_date
FROM d_academic_record o LEFT JOIN per p USING (student_id)
UNION ALL
SELECT (SELECT coalesce(max(record_id), 0) FROM d_academic_record) + row_number() OVER (ORDER BY p.student_id),
       p.student_id, {average}, {courses}, d.degree_id, d.enrollment_date
FROM per p {join} dmin d USING (student_id)
WHERE p.student_id NOT IN (SELECT student_id FROM d_academic_record)"""


_MEAN = "CAST((2 * p.s + p.n) // (2 * p.n) AS DOUBLE) / 100"

sql("academic_record", _records(f"{_MEAN} AS average, coalesce(p.n, 0) AS approved_courses", False, _MEAN, "p.n"),
    [("grows", _ROWS), ("batches", _BATCH), ("applied", _APPLIED), ("new_ce", _NEW_CE), ("dmin", _DEG_MIN),
     ("per", "SELECT student_id, sum(CAST(grade * 100 AS BIGINT)) AS s, count(*) AS n FROM new_ce WHERE grade >= 9.5 GROUP BY student_id")])

_REPLAY = """
WITH step AS (
    SELECT a.student_id, a.batch_id, a.pos, a.grade AS now,
           coalesce(lag(a.grade) OVER own, first_value(e.grade) OVER own) AS was
    FROM applied a LEFT JOIN d_course_enrollment e USING (student_id, edition_id)
    WINDOW own AS (PARTITION BY a.student_id, a.edition_id ORDER BY a.batch_id, a.pos)),
moved AS (
    SELECT *, sum(CAST(CASE WHEN now >= 9.5 THEN now ELSE 0 END * 100 AS BIGINT) - CAST(CASE WHEN was >= 9.5 THEN was ELSE 0 END * 100 AS BIGINT)) OVER up AS cents,
           sum(CAST(now >= 9.5 AS INT) - CAST(coalesce(was >= 9.5, false) AS INT)) OVER up AS courses
    FROM step WINDOW up AS (PARTITION BY student_id ORDER BY batch_id, pos ROWS UNBOUNDED PRECEDING)),
hit AS (SELECT student_id, count(*) AS k, arg_max(cents, (batch_id, pos)) AS cents, arg_max(courses, (batch_id, pos)) AS courses
        FROM moved WHERE now >= 9.5 GROUP BY student_id)
SELECT h.student_id, h.k, h.cents + coalesce(b.cents, 0) AS s, h.courses + coalesce(b.courses, 0) AS n
FROM hit h LEFT JOIN (SELECT student_id, sum(CAST(grade * 100 AS BIGINT)) AS cents, count(*) AS courses
                      FROM d_course_enrollment WHERE grade >= 9.5 GROUP BY student_id) b USING (student_id)"""

sql("academic_record_replay", _records(
    f"CASE WHEN p.k IS NULL THEN CAST(o.average AS DOUBLE) ELSE {_MEAN} END AS average, o.approved_courses + coalesce(p.k, 0) AS approved_courses",
    True, _MEAN, "p.k"),
    [("grows", _ROWS), ("batches", _BATCH), ("applied", _APPLIED), ("dmin", _DEG_MIN), ("per", _REPLAY)])

sql("enrollment_after_grades", """
SELECT e.student_id, e.edition_id, CAST(n.grade AS DOUBLE) AS grade,
       CASE WHEN l.period IS NOT NULL THEN l.period ELSE e.evaluation_period END AS evaluation_period
FROM d_course_enrollment e JOIN new_ce n USING (student_id, edition_id)
LEFT JOIN (SELECT student_id, edition_id, arg_max(period, (batch_id, pos)) AS period FROM applied GROUP BY student_id, edition_id) l
  USING (student_id, edition_id)""",
    [("grows", _ROWS), ("batches", _BATCH), ("applied", _APPLIED), ("new_ce", _NEW_CE)])


# ---------------------------------------------------------------- audit (rules of the DDL)

# Per table its key; the columns that refer to another table; further
# unique columns; optional columns; columns with a list of values or a length.
_KEYS = """users user_id; student user_id; instructor user_id; admin user_id; academic_record record_id; degree_program degree_id;
financial_account account_id; course code; course_edition edition_id; class class_id; classroom room_id; class_assignment class_id room_id;
activity activity_id; degree_enrollment student_id degree_id; course_enrollment student_id edition_id;
activity_participation student_id activity_id; instructor_assignment instructor_id edition_id; course_prerequisites course_code prerequisite_code;
degree_courses degree_id course_code; financial_transaction transaction_id; student_class student_id class_id"""
_REFERS = """student.user_id users.user_id; instructor.user_id users.user_id; admin.user_id users.user_id;
academic_record.student_id student.user_id; financial_account.student_id student.user_id; course_edition.course_code course.code;
course_edition.coordinator_id instructor.user_id; class.edition_id course_edition.edition_id; class_assignment.class_id class.class_id;
class_assignment.room_id classroom.room_id; degree_enrollment.student_id student.user_id; degree_enrollment.degree_id degree_program.degree_id;
course_enrollment.student_id student.user_id; course_enrollment.edition_id course_edition.edition_id;
activity_participation.student_id student.user_id; activity_participation.activity_id activity.activity_id;
instructor_assignment.instructor_id instructor.user_id; instructor_assignment.edition_id course_edition.edition_id;
course_prerequisites.course_code course.code; course_prerequisites.prerequisite_code course.code; degree_courses.degree_id degree_program.degree_id;
degree_courses.course_code course.code; financial_transaction.account_id financial_account.account_id;
financial_transaction.activity_id activity.activity_id; financial_transaction.degree_id degree_program.degree_id;
student_class.student_id student.user_id; student_class.class_id class.class_id"""
_UNIQUE = "users username; degree_program name; activity name; course_edition course_code year"
_REQUIRED = """users user_id username role; student user_id; instructor user_id is_coordinator; admin user_id; academic_record record_id student_id;
degree_program degree_id name tuition_fee; financial_account account_id student_id balance; course code name credits;
course_edition edition_id course_code year capacity coordinator_id; class class_id edition_id type schedule;
classroom room_id building capacity location; class_assignment class_id room_id; activity activity_id name fee;
degree_enrollment student_id degree_id enrollment_date; course_enrollment student_id edition_id;
activity_participation student_id activity_id registration_date; instructor_assignment instructor_id edition_id is_coordinator;
course_prerequisites course_code prerequisite_code; degree_courses degree_id course_code;
financial_transaction transaction_id account_id amount description transaction_date; student_class student_id class_id"""
_VALUES = """users check:role role IN ('student', 'instructor', 'admin'); class check:type trim(type) IN ('T', 'PL');
course length:code length(code) <= 10; course_edition length:course_code length(course_code) <= 10;
course_prerequisites length:course_code length(course_code) <= 10; course_prerequisites length:prerequisite_code length(prerequisite_code) <= 10;
degree_courses length:course_code length(course_code) <= 10"""


def _listed(text: str) -> list[list[str]]:
    return [line.split() for line in text.replace("\n", " ").split(";")]


def _audit_sql(source) -> str:
    def text(cols):
        return " || '|' || ".join(f"coalesce(replace(replace(CAST({c} AS VARCHAR), chr(92), chr(92) || chr(92)), '|', chr(92) || '|'), chr(92) || 'N')" for c in cols)

    def counted(table, rule, detail, where, by, having="count(*) > 0"):
        group = f" GROUP BY {', '.join(by)}" if by else ""
        return f"SELECT '{table}' AS table_name, '{rule}' AS rule, {detail} AS detail, count(*) AS n_rows FROM {source(table)} x WHERE {where}{group} HAVING {having}"

    parts = [counted(t, "primary_key", text(cols), "true", cols, "count(*) > 1") for t, *cols in _listed(_KEYS)]
    parts += [counted(t, "unique:" + ",".join(cols), text(cols), " AND ".join(f"{c} IS NOT NULL" for c in cols), cols, "count(*) > 1")
              for t, *cols in _listed(_UNIQUE)]
    parts += [counted(t, f"not_null:{c}", "''", f"{c} IS NULL", []) for t, *cols in _listed(_REQUIRED) for c in cols]
    for child, parent in _listed(_REFERS):
        (t, c), (pt, pc) = child.split("."), parent.split(".")
        parts.append(counted(t, f"foreign_key:{c}", f"CAST({c} AS VARCHAR)",
                             f"{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {source(pt)} y WHERE y.{pc} = x.{c})", [c]))
    for t, rule, *rest in _listed(_VALUES):
        c = rule.split(":")[1]
        parts.append(counted(t, rule, f"CAST({c} AS VARCHAR)", f"NOT ({' '.join(rest)})", [c]))
    return "\nUNION ALL\n".join(parts)


sql("audit_constraints", _audit_sql(lambda t: f"d_{t}"))

_FAULTY = {"course_enrollment": "f_course_enrollment", "class": "f_class"}
sql("audit_constraints_faults", _audit_sql(lambda t: _FAULTY.get(t, f"d_{t}")), [
    ("f_course_enrollment", """
        SELECT * FROM d_course_enrollment
        UNION ALL SELECT * FROM d_course_enrollment WHERE student_id % 97 = 0
        UNION ALL SELECT student_id, -edition_id - 1, grade, attendance, evaluation_period
                  FROM d_course_enrollment WHERE student_id % 89 = 1"""),
    ("f_class", "SELECT class_id, edition_id, CASE WHEN class_id % 101 = 0 THEN 'X' ELSE type END AS type, schedule FROM d_class"),
])

# ---------------------------------------------------------------- programmes, refunds, ledger

_CANCELLED = """
SELECT r.seq, r.student_id, r.activity_id, p.student_id IS NOT NULL AS takes_part,
       min(r.seq) OVER (PARTITION BY r.student_id, r.activity_id) = r.seq AS first_one
FROM r_cancellation r LEFT JOIN d_activity_participation p USING (student_id, activity_id)"""

sql("activity_refunds", """
SELECT seq, student_id, activity_id,
       CASE WHEN NOT takes_part THEN 'not_enrolled' WHEN first_one THEN 'ok' ELSE 'already_cancelled' END AS status,
       CASE WHEN takes_part AND first_one THEN student_id IN (SELECT student_id FROM d_financial_account) END AS fee_refunded
FROM cancelled""", [("cancelled", _CANCELLED)])

sql("refund_balances", """
SELECT f.account_id, f.student_id, CAST(f.balance - coalesce(sum(a.fee), 0) AS DOUBLE) AS balance
FROM d_financial_account f
LEFT JOIN (SELECT * FROM cancelled WHERE takes_part AND first_one) c USING (student_id)
LEFT JOIN d_activity a ON a.activity_id = c.activity_id
GROUP BY f.account_id, f.student_id, f.balance""", [("cancelled", _CANCELLED)])

sql("charge_ledger", """
SELECT charge_id, student_id, kind, CAST(amount AS DOUBLE) AS amount, charge_date,
       CAST(sum(amount) OVER (PARTITION BY student_id ORDER BY charge_date, charge_id) AS DOUBLE) AS balance_after
FROM d_charge""")

sql("program_restriction", """
SELECT g.student_id, g.edition_id,
       EXISTS (SELECT 1 FROM d_degree_courses dc JOIN d_degree_enrollment de USING (degree_id)
               WHERE de.student_id = g.student_id AND dc.course_code = o.course_code) AS in_program
FROM d_course_enrollment g JOIN d_course_edition o USING (edition_id)""")

sql("degree_progress", """
WITH plan AS (SELECT DISTINCT dc.degree_id, k.code, k.credits FROM d_degree_courses dc JOIN d_course k ON k.code = dc.course_code)
SELECT de.student_id, de.degree_id,
       CAST(coalesce(sum(plan.credits) FILTER ((de.student_id, plan.code) IN (SELECT (student_id, code) FROM passed)), 0) AS BIGINT) AS credits_passed,
       CAST(coalesce(sum(plan.credits), 0) AS BIGINT) AS credits_required
FROM (SELECT DISTINCT student_id, degree_id FROM d_degree_enrollment) de LEFT JOIN plan USING (degree_id)
GROUP BY de.student_id, de.degree_id""", [("offering", _OFFERING), ("passed", _PASSED)])

sql("passed_last_12_months", """
SELECT o.course_code, count(*) AS passed
FROM d_grade_date t JOIN d_course_enrollment g USING (student_id, edition_id) JOIN d_course_edition o USING (edition_id)
WHERE g.grade >= 9.5 AND t.graded_on <= DATE '2001-12-31' AND t.graded_on > DATE '2000-12-31'
GROUP BY o.course_code""")

# ---------------------------------------------------------------- streaming (final state = batch SQL)

sql("stream_balances", """
SELECT student_id, CAST(sum(amount) AS DOUBLE) AS balance, count(*) AS n_charges FROM d_charge GROUP BY student_id""")

sql("stream_academic_record", """
SELECT t.student_id, CASE WHEN p.n > 0 THEN CAST((2 * p.s + p.n) // (2 * p.n) AS DOUBLE) / 100 END AS average,
       coalesce(p.n, 0) AS approved_courses
FROM (SELECT DISTINCT student_id FROM applied) t
LEFT JOIN (SELECT student_id, sum(CAST(grade * 100 AS BIGINT)) AS s, count(*) AS n FROM new_ce
           WHERE grade >= 9.5 GROUP BY student_id) p ON p.student_id = t.student_id""",
    [("grows", _ROWS), ("batches", _BATCH), ("applied", _APPLIED), ("new_ce", _NEW_CE)])


# ---------------------------------------------------------------- stored tables end like the plain ones

SQL["academic_record_incremental"] = SQL["academic_record"]
SQL["stored_grades"] = SQL["enrollment_after_grades"]
SQL["stored_insert_if_absent"] = SQL["insert_if_absent"]
SQL["stored_tuition"] = SQL["post_tuition"]
SQL["stored_erasure"] = f"SELECT table_name, n_rows, 0 AS residual FROM ({SQL['erase_students_tables']}) r"


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
