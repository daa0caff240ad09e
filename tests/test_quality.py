"""Clean tables give no finding; each injected fault is reported."""

from datetime import date

from helpers import D, campus

from registrar.operators.quality import audit_constraints


def test_audit_clean_and_faulty(spark):
    clean = dict(users=[(1, "a", None, "student"), (2, "b", None, "instructor")],
                 student=[(1, "A", None, None, None)], instructor=[(2, True)],
                 course=[("EI", "Eng", 6)], course_edition=[(100, "EI", 2024, 10, None, 2)],
                 course_enrollment=[(1, 100, D(12), None, None)],
                 degree_program=[(1, "LEI", D(10))], degree_enrollment=[(1, 1, date(2024, 1, 1))])
    T = campus(spark, **clean)
    names = list(clean)
    assert audit_constraints(T, names).count() == 0
    bad = dict(clean)
    bad["users"] = clean["users"] + [(3, "a", None, "teacher")]                    # unique + domain
    bad["course_enrollment"] = clean["course_enrollment"] * 2 + [(5, 999, None, None, None)]  # dup key + orphans
    bad["course"] = clean["course"] + [("ABCDEFGHIJK", "Long", 1)]                   # varchar(10)
    T = campus(spark, **bad)
    got = {(r.table_name, r.rule, r.detail, r.n_rows) for r in audit_constraints(T, names).collect()}
    assert got == {("users", "unique:username", "a", 2), ("users", "check:role", "teacher", 1),
                   ("course_enrollment", "primary_key", "1|100", 2),
                   ("course_enrollment", "foreign_key:student_id", "5", 1),
                   ("course_enrollment", "foreign_key:edition_id", "999", 1),
                   ("course", "length:code", "ABCDEFGHIJK", 1)}


def test_keys_with_bars_and_missing_tables(spark):
    T = campus(spark, course_prerequisites=[("a|b", "c"), ("a", "b|c")], course=[("a|b", "x", 1), ("c", "x", 1), ("a", "x", 1), ("b|c", "x", 1)])
    T = {n: T[n] for n in ("course_prerequisites", "course")}
    assert audit_constraints(T, ["course_prerequisites", "course"]).count() == 0
    got = [(r.table_name, r.rule) for r in audit_constraints(T, ["course", "class"]).collect()]
    assert got == [("class", "missing_table")]


def test_bitmaps_sparse_ids_nulls_and_negative_ids_agree(spark):
    far = 40_000_000_000
    users = [(i, f"u{i}", None, "student") for i in (0, 1, 2, -5, 32768, 32769)]
    enrol = [(0, 1), (1, 1), (2, 1), (-5, 1), (32768, 1), (32769, 1), (32769, 1), (-6, 1), (3, 1), (3, 2)]
    dense = campus(spark, users=users, student=[(u[0], "x", None, None, None) for u in users],
                   course_enrollment=[(*e, None, None, None) for e in enrol])
    sparse = campus(spark, users=[(u[0] * far, *u[1:]) for u in users], student=[(u[0] * far, "x", None, None, None) for u in users],
                    course_enrollment=[(s * far, e, None, None, None) for s, e in enrol])
    names = ["users", "student", "course_enrollment"]
    assert {(r.table_name, r.rule, r.detail, r.n_rows) for r in audit_constraints(dense, names).collect()} == {
        ("course_enrollment", "primary_key", "32769|1", 2), ("course_enrollment", "foreign_key:student_id", "-6", 1),
        ("course_enrollment", "foreign_key:student_id", "3", 2)}
    assert {(r.rule, r.detail, r.n_rows) for r in audit_constraints(sparse, names).collect()} == {
        ("primary_key", f"{32769 * far}|1", 2), ("foreign_key:student_id", str(-6 * far), 1), ("foreign_key:student_id", str(3 * far), 2)}


def test_repeated_null_and_integer_keys(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (7, 3), (7, 4), (8, 5)], "user_id long, x long").select("user_id")
    got = {(r.rule, r.detail, r.n_rows) for r in audit_constraints({"admin": rows}, ["admin"]).collect()}
    assert got == {("primary_key", "\\N", 2), ("primary_key", "7", 2), ("not_null:user_id", "", 2)}


def test_audit_stores_no_table_that_follows_from_a_stored_one(monkeypatch):
    """Tables that follow row by row from a kept one are audited as they are, faults among them; the others are stored once."""
    from registrar.plans import catalog

    class Kept:
        spark = None
        keep = staticmethod(lambda *names: None)
        __getattr__ = lambda self, name: name

    stored, seen = [], []
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: name)
    monkeypatch.setattr(catalog, "store_tables", lambda tables, root, names, by_year: stored.extend(names))
    monkeypatch.setattr(catalog, "load_tables", lambda spark, root, names: {n: f"stored {n}" for n in names})
    monkeypatch.setattr(catalog.Q, "audit_constraints", lambda tables, names: seen.append((tables, names)))
    catalog._audited(Kept(), {"course_enrollment": "faulty"})
    (tables, names), = seen
    assert set(names) == set(tables) == set(catalog.AUDITED) and len(stored) == len(set(stored))
    assert not set(stored) & {"course_enrollment", "student_class", "class"} and set(stored) | set(catalog.FOLLOWING) == set(names)
    assert tables["course_enrollment"] == "faulty" and all(tables[n] == (f"stored {n}" if n in stored else n) for n in names if n != "course_enrollment")
