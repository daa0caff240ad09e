"""Stored tables: writes by key rewrite the buckets they touch, and erasure is confirmed."""

import glob
import os
import tempfile
from datetime import date

import pytest
from helpers import D, campus

from registrar.operators import ingest as I
from registrar.sources.versions import Conflict, StoredTable

SCHEMA = "k long, j string, v int"


def stored(spark, rows, buckets=8, by=("k",)):
    root = tempfile.mkdtemp(prefix="registrar-versions-", dir="/tmp")
    return StoredTable.create(spark.createDataFrame(rows, SCHEMA), f"{root}/t", ["k", "j"], by, buckets)


def rows_of(t, version=None):
    return sorted(map(tuple, t.read(version).collect()))


def files(t):
    out = {}
    for b, commit in t.version()["commits"].items():
        out[b] = {(f, os.stat(f).st_mtime_ns, os.stat(f).st_ino) for f in glob.glob(f"{t.root}/data/{commit}/bucket={b}/*.parquet")}
    return out


def test_update_keeps_the_files_of_other_buckets(spark):
    base = [(i, "a", i) for i in range(200)] + [(i, "b", -i) for i in range(50)]
    t = stored(spark, base)
    before = files(t)
    assert len(before) == 8 and all(before.values())
    t.update(spark.createDataFrame([(3, "a", 99), (3, "zz", 1), (5000, "a", 1)], SCHEMA))
    assert rows_of(t) == sorted([r if r[:2] != (3, "a") else (3, "a", 99) for r in base])
    after = files(t)
    touched = {b for b in before if before[b] != after[b]}
    assert len(touched) <= 2 and before.keys() == after.keys()
    assert rows_of(t, 0) == sorted(base)  # readers of the version before still have it
    gone = t.vacuum()
    assert len(gone) == len(touched) and t.versions() == [1]
    assert all(not os.path.exists(f"{t.root}/data/{g}") for g in gone) and files(t) == after


def test_insert_upsert_and_delete(spark):
    t = stored(spark, [(1, "a", 1), (2, "b", None)])
    t.insert_if_absent(spark.createDataFrame([(1, "a", 7), (1, "c", 8), (9, "a", 9)], SCHEMA))
    assert rows_of(t) == [(1, "a", 1), (1, "c", 8), (2, "b", None), (9, "a", 9)]
    t.upsert(spark.createDataFrame([(2, "b", 5), (1, "a", None), (4, "d", 4)], SCHEMA))
    assert rows_of(t) == [(1, "a", None), (1, "c", 8), (2, "b", 5), (4, "d", 4), (9, "a", 9)]
    t.upsert(spark.createDataFrame([(2, "b")], "k long, j string"))  # no other column: nothing changes
    assert (2, "b", 5) in rows_of(t)
    t.delete_by("k", spark.createDataFrame([(1,), (4,), (None,), (77,)], "k long"))
    assert rows_of(t) == [(2, "b", 5), (9, "a", 9)]
    t.delete(spark.createDataFrame([(2, "b", 0), (9, "a", 0)], SCHEMA))
    assert rows_of(t) == [] and t.read().columns == ["k", "j", "v"]
    t.insert_if_absent(spark.createDataFrame([(3, "x", 3)], SCHEMA))
    assert rows_of(t) == [(3, "x", 3)]
    number = t.versions()[-1]
    assert t.delete(t.read().limit(0)) == number  # nothing to write, no version


def test_empty_table_conflicts_and_repeated_keys(spark):
    t = stored(spark, [])
    assert rows_of(t) == []
    t.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    said = t.version()
    with pytest.raises(ValueError):
        t.update(spark.createDataFrame([(1, "a", 1), (1, "a", 2)], SCHEMA))
    with pytest.raises(Conflict):  # another writer published the same number
        t._publish(said["number"], said)
    assert t.version() == said and rows_of(t) == [(1, "a", 1)]


def erasure_tables(spark):
    day = date(2024, 1, 1)
    return campus(
        spark, users=[(1, "a", None, "student"), (2, "b", None, "student"), (3, "c", None, "instructor")],
        student=[(1, "A", None, None, None), (2, "B", None, None, None)], degree_enrollment=[(1, 1, day), (2, 1, day)],
        course_enrollment=[(1, 100, D(12), None, None), (1, 101, None, None, None), (2, 100, D(9), None, None)],
        financial_account=[(11, 1, D(5), None), (12, 2, D(6), None)], student_class=[(1, 5), (2, 5)],
        academic_record=[(7, 1, D(12), 1, None, 1, day)], activity_participation=[(2, "x", day)],
        financial_transaction=[(1, 11, D(5), "fee", __import__("datetime").datetime(2024, 1, 1), None, None),
                               (2, 12, D(6), "fee", __import__("datetime").datetime(2024, 1, 1), None, None)])


def test_stored_erasure_leaves_none_and_equals_the_plain_one(spark):
    T = erasure_tables(spark)
    req = spark.createDataFrame([(1, 1), (2, 3), (3, 99), (4, 1)], "seq long, student_id long")
    made = I.store_student_tables(T, tempfile.mkdtemp(prefix="registrar-erase-", dir="/tmp"), 4)
    out = I.erase_stored(made, req)
    plain = I.erase_students(T, req)
    assert sorted(map(tuple, out.outcome.collect())) == sorted(map(tuple, plain.outcome.collect()))
    for name, _ in I.student_tables():
        assert sorted(map(str, out.tables[name].collect())) == sorted(map(str, plain.tables[name].select(out.tables[name].columns).collect())), name
    assert {r.residual for r in out.tables["confirmation"].collect()} == {0}
    assert [n for n, _ in I.student_tables() if I._depth(n) > I._depth("financial_account")] == ["financial_transaction"]


def test_faulty_write_is_confirmed_as_residual(spark, monkeypatch):
    made = I.store_student_tables(erasure_tables(spark), tempfile.mkdtemp(prefix="registrar-erase-", dir="/tmp"), 4)
    delete_by = StoredTable.delete_by
    lossy = lambda self, column, values: None if "course_enrollment" in self.root else delete_by(self, column, values)
    monkeypatch.setattr(StoredTable, "delete_by", lossy)
    out = I.erase_stored(made, spark.createDataFrame([(1, 1)], "seq long, student_id long"))
    left = {r.table_name: r.residual for r in out.tables["confirmation"].collect()}
    assert left.pop("course_enrollment") == 2 and set(left.values()) == {0}
