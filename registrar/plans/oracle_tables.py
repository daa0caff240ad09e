"""The fixture derivation of ``sources/fixtures.py`` written again in plain SQL.

Each entry is one CTE over the raw test views (region nation customer supplier
part orders lineitem events). ``with_tables`` prefixes a query with the CTEs it
needs, in dependency order. Written independently of the Spark code so the
oracle check also covers the derivation.
"""

from __future__ import annotations

import re

IB = "(SELECT u FROM d_unit)"  # more than any id of a customer, a supplier or an event's user


def _code(expr: str) -> str:
    text = f"CAST({expr} AS VARCHAR)"
    return f"('C' || CASE WHEN length({text}) < 3 THEN lpad({text}, 3, '0') ELSE {text} END)"


CTES: dict[str, str] = {
    "d_unit": """
        SELECT 1 + max(id) AS u
        FROM (SELECT c_custkey AS id FROM customer UNION ALL SELECT s_suppkey FROM supplier UNION ALL SELECT user_id FROM events)""",
    "enr0": f"""
        SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber,
               l.l_quantity, l.l_returnflag, CAST(o.o_orderdate AS DATE) AS ordered_on,
               l.l_partkey AS cno,
               CAST(year(o.o_orderdate) AS BIGINT) AS yr,
               l.l_partkey * 10 + (CAST(year(o.o_orderdate) AS BIGINT) - 1995) AS edition_id,
               o.o_custkey AS student_id
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "d_student": """
        SELECT c.c_custkey AS user_id, c.c_name AS name,
               CASE WHEN c.c_custkey % 40 <> 0 THEN n.n_name END AS district
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "d_users": f"""
        SELECT c_custkey AS user_id, c_name AS username, 's' || CAST(c_custkey AS VARCHAR) || '@uni.example' AS email,
               'student' AS role FROM customer
        UNION ALL
        SELECT s_suppkey + {IB}, s_name, 'i' || CAST(s_suppkey AS VARCHAR) || '@uni.example', 'instructor'
        FROM supplier
        UNION ALL
        SELECT n_nationkey + 4 * {IB}, 'admin-' || n_name, NULL, 'admin' FROM nation""",
    "d_admin": f"SELECT n_nationkey + 4 * {IB} AS user_id FROM nation",
    "d_instructor": f"""
        SELECT s_suppkey + {IB} AS user_id, s_suppkey % 3 = 0 AS is_coordinator FROM supplier""",
    "d_course": f"""
        SELECT {_code('p_partkey')} AS code, p_name AS name, CAST(3 + p_partkey % 10 AS BIGINT) AS credits
        FROM part""",
    "d_course_edition": f"""
        SELECT edition_id, {_code('cno')} AS course_code, yr AS year, CAST(2 + cno % 8 AS BIGINT) AS capacity,
               min(l_suppkey) + {IB} * CASE WHEN cno % 10 = 9 THEN 2 ELSE 1 END AS coordinator_id
        FROM enr0 GROUP BY edition_id, cno, yr""",
    "d_course_enrollment": """
        SELECT student_id, edition_id,
               CAST(max(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) * 0.4 AS DECIMAL(5,2)) AS grade,
               CAST(max(l_linenumber) AS BIGINT) AS attendance,
               max(CASE l_returnflag WHEN 'A' THEN 'Normal' WHEN 'R' THEN 'Recurso' END) AS evaluation_period
        FROM enr0 GROUP BY student_id, edition_id""",
    "d_instructor_assignment": f"""
        SELECT i.instructor_id, i.edition_id, i.instructor_id = ed.coordinator_id AS is_coordinator
        FROM (SELECT DISTINCT l_suppkey + {IB} AS instructor_id, edition_id FROM enr0) i
        JOIN d_course_edition ed ON ed.edition_id = i.edition_id""",
    "d_degree_program": """
        SELECT CAST(row_number() OVER (ORDER BY c_mktsegment) AS BIGINT) AS degree_id, c_mktsegment AS name,
               CAST(4000 + 500 * row_number() OVER (ORDER BY c_mktsegment) AS DECIMAL(10,2)) AS tuition_fee
        FROM (SELECT DISTINCT c_mktsegment FROM customer) s""",
    "d_degree_enrollment": """
        WITH own AS (
            SELECT c.c_custkey AS student_id, dp.degree_id,
                   coalesce(f.first_order, DATE '1995-01-01') AS enrollment_date
            FROM customer c JOIN d_degree_program dp ON dp.name = c.c_mktsegment
            LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_order
                       FROM orders GROUP BY o_custkey) f ON f.o_custkey = c.c_custkey)
        SELECT student_id, degree_id, enrollment_date FROM own
        UNION ALL
        SELECT student_id, degree_id % (SELECT count(*) FROM d_degree_program) + 1, enrollment_date FROM own WHERE student_id % 10 = 0""",
    "d_degree_courses": f"""
        SELECT p_partkey % (SELECT count(*) FROM d_degree_program) + 1 AS degree_id, {_code('p_partkey')} AS course_code FROM part
        UNION ALL
        SELECT (p_partkey + 2) % (SELECT count(*) FROM d_degree_program) + 1, {_code('p_partkey')} FROM part WHERE p_partkey % 7 = 0""",
    "d_course_prerequisites": f"""
        SELECT {_code('p_partkey')} AS course_code, {_code('p_partkey - 1')} AS prerequisite_code
        FROM part WHERE p_partkey % 30 = 1""",
    "d_class": """
        SELECT edition_id * 2 AS class_id, edition_id, 'T' AS type, 'theory' AS schedule FROM d_course_edition
        UNION ALL
        SELECT edition_id * 2 + 1, edition_id, 'PL', 'lab' FROM d_course_edition""",
    "d_activity": """
        SELECT event_type AS activity_id, event_type AS name,
               CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS rk,
               CAST(20 + 5 * row_number() OVER (ORDER BY event_type) AS DECIMAL(10,2)) AS fee
        FROM (SELECT DISTINCT event_type FROM events) t""",
    "d_activity_participation": """
        SELECT user_id AS student_id, event_type AS activity_id, CAST(min(ts) AS DATE) AS registration_date
        FROM events GROUP BY user_id, event_type""",
    "d_financial_account": """
        SELECT de.student_id + 1 AS account_id, de.student_id, CAST(sum(dp.tuition_fee) AS DECIMAL(10,2)) AS balance
        FROM d_degree_enrollment de JOIN d_degree_program dp ON dp.degree_id = de.degree_id
        WHERE de.student_id % 4 <> 3 GROUP BY de.student_id""",
    "d_charge": """
        SELECT de.student_id * (SELECT (SELECT count(*) FROM d_degree_program) + (SELECT count(*) FROM d_activity)) + de.degree_id - 1 AS charge_id, de.student_id, dp.tuition_fee AS amount,
               'tuition' AS kind, de.enrollment_date AS charge_date
        FROM d_degree_enrollment de JOIN d_degree_program dp ON dp.degree_id = de.degree_id
        UNION ALL
        SELECT ap.student_id * (SELECT (SELECT count(*) FROM d_degree_program) + (SELECT count(*) FROM d_activity)) + (SELECT count(*) FROM d_degree_program) + a.rk - 1, ap.student_id, a.fee, 'activity', ap.registration_date
        FROM d_activity_participation ap JOIN d_activity a ON a.activity_id = ap.activity_id""",
    "d_financial_transaction": """
        SELECT ch.charge_id AS transaction_id, fa.account_id, ch.amount, 'charge: ' || ch.kind AS description,
               CAST(ch.charge_date AS TIMESTAMP) AS transaction_date, CAST(NULL AS VARCHAR) AS activity_id,
               CAST(NULL AS BIGINT) AS degree_id
        FROM d_charge ch JOIN d_financial_account fa ON fa.student_id = ch.student_id""",
    "d_student_class": """
        SELECT student_id, edition_id * 2 AS class_id FROM d_course_enrollment
        UNION ALL
        SELECT student_id, edition_id * 2 + 1 FROM d_course_enrollment WHERE attendance % 2 = 1""",
    "d_academic_record": """
        SELECT student_id AS record_id, student_id, CAST(10 AS DECIMAL(5,2)) AS average, CAST(1 AS BIGINT) AS approved_courses,
               CAST(NULL AS BIGINT) AS current_semester, min(degree_id) AS degree_id, DATE '1995-01-01' AS enrollment_date
        FROM d_degree_enrollment WHERE student_id % 3 = 0 GROUP BY student_id""",
    "d_grade_date": """
        SELECT student_id, edition_id, max(ordered_on) AS graded_on FROM enr0 WHERE l_returnflag <> 'N' GROUP BY student_id, edition_id""",
    "r_cancellation": """
        SELECT event_id AS seq, user_id + CASE WHEN event_id % 12 = 11 THEN 7 ELSE 0 END AS student_id, event_type AS activity_id
        FROM events WHERE event_id % 6 = 5""",
    "d_classroom": "SELECT n_nationkey AS room_id, n_name AS building, CAST(30 AS BIGINT) AS capacity, 'campus' AS location FROM nation",
    "d_class_assignment": "SELECT class_id, class_id % 30 AS room_id FROM d_class",
    "r_admission": f"""
        SELECT x.seq, x.student_id, x.ed AS edition_id,
               CASE WHEN x.seq % 13 = 0 THEN CAST([] AS BIGINT[])
                    WHEN x.seq % 11 = 0 THEN [x.ed * 2, x.ed * 2 + 3] ELSE [x.ed * 2, x.ed * 2 + 1] END AS classes
        FROM (SELECT e.event_id AS seq,
                     CASE WHEN e.event_id % 31 = 0 THEN e.user_id + 3 * {IB}
                          WHEN e.event_id % 9 = 0 AND p.ed IS NOT NULL THEN p.student ELSE e.user_id END AS student_id,
                     CASE WHEN e.event_id % 9 = 0 AND p.ed IS NOT NULL THEN p.ed
                          ELSE e.event_id * 7 % (SELECT count(*) + count(*) // 30 + 1 FROM part) * 10 + e.event_id % 7 END AS ed
              FROM events e
              LEFT JOIN (SELECT l_orderkey, min(edition_id) AS ed, min(student_id) AS student FROM enr0 GROUP BY l_orderkey) p
                ON p.l_orderkey = e.event_id
              WHERE e.event_type = 'signup') x""",
    "r_degree": f"""
        SELECT event_id AS seq, CASE WHEN event_id % 23 = 0 THEN user_id + 3 * {IB} ELSE user_id END AS student_id,
               event_id % ((SELECT count(*) FROM d_degree_program) + 2) AS degree_id,
               CASE WHEN event_id % 19 <> 0 THEN CAST(ts AS DATE) END AS date
        FROM events WHERE event_type = 'click'""",
    "r_activity": """
        SELECT e.event_id AS seq, e.user_id * 13 AS student_id,
               coalesce(a.activity_id, 'unknown-' || CAST(e.event_id % ((SELECT count(*) FROM d_activity) + 1) AS VARCHAR)) AS activity_id
        FROM events e LEFT JOIN d_activity a ON a.rk = e.event_id % ((SELECT count(*) FROM d_activity) + 1)
        WHERE e.event_type = 'purchase'""",
    "r_registration": """
        SELECT event_id AS seq,
               CASE WHEN event_id % 17 <> 0 THEN
                    'Customer#' || lpad(CAST(event_id % (2 * (SELECT count(*) FROM customer)) AS VARCHAR), 9, '0') END AS username,
               CASE WHEN event_id % 23 <> 0 THEN 'r' || CAST(event_id AS VARCHAR) || '@mail.example' END AS email,
               event_id % 29 <> 0 AS password_present,
               CASE WHEN event_id % 3 = 0 THEN TRUE END AS is_coordinator
        FROM events WHERE event_type = 'view'""",
    "r_grade_batch": """
        SELECT b.batch_id, CASE WHEN b.edition_id % 50 = 3 THEN -b.edition_id - 1 ELSE b.edition_id END AS edition_id,
               CASE WHEN b.edition_id % 20 = 0 THEN ed.coordinator_id + 1 ELSE ed.coordinator_id END AS submitter_id,
               CASE WHEN b.edition_id % 50 = 6 THEN NULL
                    WHEN b.l_linenumber % 2 = 1 THEN 'Normal' ELSE 'Recurso' END AS period
        FROM (SELECT DISTINCT edition_id * 100 + l_linenumber AS batch_id, edition_id, l_linenumber FROM enr0) b
        LEFT JOIN d_course_edition ed ON ed.edition_id = b.edition_id""",
    "r_grade_row": """
        SELECT edition_id * 100 + l_linenumber AS batch_id,
               row_number() OVER (PARTITION BY edition_id, l_linenumber
                                  ORDER BY l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag) - 1 AS pos,
               CASE WHEN l_orderkey % 89 = 0 THEN -1 ELSE student_id END AS p_student,
               CASE WHEN l_orderkey % 97 = 0 THEN 25.0 WHEN l_orderkey % 79 = 0 THEN NULL ELSE CAST(l_quantity * 0.4 AS DOUBLE) END AS p_grade,
               CASE WHEN l_orderkey % 83 = 0 THEN 3 ELSE 2 END AS p_size
        FROM enr0""",
    "r_erasure": f"""
        SELECT user_id AS seq, user_id AS student_id FROM d_users
        WHERE user_id % 50 = 0 OR (user_id >= {IB} AND user_id % 10 = 5)
        UNION ALL
        SELECT c_custkey + 3 * {IB}, c_custkey + 3 * {IB} FROM customer WHERE c_custkey % 500 = 7""",
}

_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str) -> list[str]:
    words = set(_NAME.findall(CTES[name]))
    return [d for d in CTES if d != name and d in words]


def with_tables(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """``WITH <needed fixture CTEs>, <extra CTEs> <body>``; needs found by name."""
    extra_ctes = extra_ctes or []
    text = body + " ".join(sql for _, sql in extra_ctes)
    need: list[str] = []

    def visit(n: str):
        if n in need:
            return
        for d in _deps(n):
            visit(d)
        need.append(n)

    words = set(_NAME.findall(text))
    for n in CTES:
        if n in words:
            visit(n)
    parts = [f"{n} AS ({CTES[n]})" for n in need] + [f"{n} AS ({sql})" for n, sql in extra_ctes]
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        # the body has CTEs of its own: append them to the fixture list
        return ("WITH " + ",\n".join(parts) + ",\n" + stripped[5:]) if parts else body
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
